"""Registered queries over the synthetic tables, each through the library's operators, with DuckDB oracles.

The posts of a pipeline don't occur in the synthetic tables.  `events` stands
in for bronze rows (`BRONZE`): each post has five, urls and captions are
missing in part, and rows are dealt to three datasets.  Queries of scans and of
state write what they read to a lake of their own first, in the shared folder.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .config import EnrichConfig, Lake
from .functions import is_blank, json_valid, lenient_timestamp, list_to_json, post_url
from .operators import checks, enrich
from .operators.dedup import diagonal_union, latest_per_key
from .operators.normalize import add_defaults, normalize, rename_columns, stamp
from .operators.scd2 import apply_names, changed_rows, max_key, observed_names
from .operators.upsert import progress, upsert
from .operators.views import analytics_view
from .plans.gold import run_gold
from .plans.migrate import migrated_posts, seed_mark
from .plans.serving import run_dim_time
from .plans.silver import newest_first, run_silver
from .session import shared_folder
from .sources.bronze import datasets, newest, scan
from .sources.files import file_system, listing
from .sources.ndjson import scan_ndjson as read_ndjson
from .sources.reader import FORMAT as STATE_FORMAT
from .sources.reader import PUSHDOWN, StateSource
from .sources.state import BUCKET, Constraints, MissingParent, State, StateTable

RUN_TS = "2024-07-01 00:00:00"
MARK = "2024-01-16 00:00:00"

BRONZE = """
    SELECT cast(cast(floor(event_id / 5) AS bigint) AS string) AS post_id, event_id,
           concat('s', cast(event_id AS string)) AS shortcode,
           CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('https://x/', cast(event_id AS string)) END AS url,
           CASE WHEN event_id % 7 = 0 THEN '  ' ELSE event_type END AS caption,
           cast(user_id AS string) AS owner_id, event_type AS owner_username,
           cast(floor(value) AS int) AS likes_count, date_trunc('day', ts) AS timestamp, ts AS raw_ts,
           concat('ds_', cast(event_id % 3 AS string)) AS source_dataset
    FROM events
"""
_LATEST = "SELECT DISTINCT ON (post_id) * FROM bronze ORDER BY post_id, timestamp DESC NULLS LAST, source_dataset DESC, event_id"
_POSTS = f"WITH bronze AS ({BRONZE}), posts AS ({_LATEST})"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / 5).cast("string").alias("post_id"),
        "event_id",
        F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("shortcode"),
        F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("https://x/"), F.col("event_id").cast("string"))).alias("url"),
        F.when(F.col("event_id") % 7 == 0, F.lit("  ")).otherwise(F.col("event_type")).alias("caption"),
        F.col("user_id").cast("string").alias("owner_id"),
        F.col("event_type").alias("owner_username"),
        F.floor("value").cast("int").alias("likes_count"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("timestamp"),
        F.col("ts").cast("timestamp_ntz").alias("raw_ts"),
        F.concat(F.lit("ds_"), (F.col("event_id") % 3).cast("string")).alias("source_dataset"),
    )


def _latest(bronze: DataFrame, time: str = "timestamp") -> DataFrame:
    return latest_per_key(bronze, ["post_id"], [F.desc_nulls_last(time), F.desc_nulls_last("source_dataset"), F.asc_nulls_last("event_id")])


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(_bronze(spark, sf_dir))


def _ts(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


_REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def _register(oracle: str | None = None, name: str | None = None):
    """Register a query under its function's name or another, with its oracle."""

    def keep(f):
        _REGISTRY[name or f.__name__] = (f, oracle)
        return f

    return keep


# --- scans, projections, filters -------------------------------------------


def _lake(spark: SparkSession) -> Lake:
    """A new lake in the shared folder, which goes when the application ends."""
    root = f"{shared_folder(spark)}/lake-{uuid.uuid4().hex}"
    fs, path = file_system(spark, root)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return Lake.at(root)


@_register("""SELECT n_nationkey AS id, n_name, CASE WHEN n_nationkey % 3 > 0 THEN n_regionkey END AS n_regionkey, concat('nations_', cast(n_nationkey % 3 AS varchar)) AS source_dataset FROM nation""")
def scan_parquet(spark, sf_dir):
    """Three datasets of nations, one of which lacks a column, through the scan of the lake."""
    lake, nations = _lake(spark), _table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "id")
    for k in range(3):
        own = nations.where(F.col("id") % 3 == k).select("id", "n_name", *(["n_regionkey"] if k else []))
        own.write.parquet(f"{lake.bronze}/" + (f"dataset_id=nations_{k}" if k == 2 else f"nations_{k}.parquet"))
    return diagonal_union(scan(spark, datasets(spark, lake.bronze)).frames).select("id", "n_name", "n_regionkey", "source_dataset")


@_register("SELECT cast(json_extract(props, '$.k') AS bigint) AS k FROM events")
def scan_ndjson(spark, sf_dir):
    """The lines of `events.props`, written as an NDJSON file and read with an inferred schema."""
    path = f"{_lake(spark).bronze}/events.jsonl"
    _table(spark, sf_dir, "events").select("props").write.text(path)
    return read_ndjson(spark, path)


@_register("SELECT doc_id AS post_id, 3 AS schema_version, concat('{\"quality\":', cast(quality AS varchar), '}') AS result_json FROM labels")
def project_gold(spark, sf_dir):
    return _gold(spark, sf_dir).select("post_id", "schema_version", "result_json")


def _gold(spark, sf_dir):
    analyzed = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("post_id"), F.lit(True).alias("ok"), F.concat(F.lit('{"quality":'), F.col("quality").cast("string"), F.lit("}")).alias("result_json"))
    return enrich.analyses(analyzed, _ts(RUN_TS))


@_register("SELECT event_id AS post_id, user_id AS owner_id, event_type AS caption, ts AS timestamp FROM events")
def project_rename(spark, sf_dir):
    names = {"event_id": "post_id", "user_id": "owner_id", "event_type": "caption", "ts": "timestamp", "absent": "other"}
    return rename_columns(_table(spark, sf_dir, "events"), names).select("post_id", "owner_id", "caption", "timestamp")


@_register("""SELECT cast(event_id AS varchar) AS post_id, cast(0 AS int) AS video_play_count, cast(0 AS int) AS video_view_count, '[]' AS hashtags,
    cast(NULL AS varchar) AS meta_data, false AS has_engagement_bait, '[]' AS media_files, cast(0 AS int) AS media_count FROM events""")
def project_defaults(spark, sf_dir):
    rows = add_defaults(_table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("post_id")))
    return rows.select("post_id", "video_play_count", "video_view_count", "hashtags", "meta_data", "has_engagement_bait", "media_files", "media_count")


@_register(f"WITH bronze AS ({BRONZE}) SELECT event_id, CASE WHEN url IS NULL THEN concat('https://instagram.com/p/', shortcode, '/') ELSE url END AS url FROM bronze")
def derive_url(spark, sf_dir):
    return _bronze(spark, sf_dir).select("event_id", post_url(F.col("url"), F.col("shortcode")).alias("url"))


@_register("SELECT doc_id, cast(to_json([lang, source]) AS varchar) AS tags FROM documents", "list_to_json")
def list_to_json_text(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", list_to_json(F.array("lang", "source")).alias("tags"))


@_register("""SELECT event_id, try_cast(regexp_replace(CASE WHEN event_id % 11 = 0 THEN 'not a time' ELSE concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 'Z') END, 'Z$', '') AS timestamp) AS parsed FROM events""")
def parse_timestamp(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 11 == 0, F.lit("not a time")).otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    return events.select("event_id", lenient_timestamp(text).alias("parsed"))


@_register(f"WITH bronze AS ({BRONZE}) SELECT event_id, url FROM bronze WHERE url IS NOT NULL")
def filter_not_null(spark, sf_dir):
    """Rows without an id are left out by `normalize`; here urls are the ids."""
    rows = _bronze(spark, sf_dir).select(F.col("url").alias("id"), F.col("event_id").cast("string").alias("caption"), "source_dataset")
    return normalize(rows, F.col("source_dataset")).select(F.col("caption").cast("long").alias("event_id"), F.col("post_id").alias("url"))


@_register(f"WITH bronze AS ({BRONZE}) SELECT event_id, coalesce(CASE WHEN url IS NOT NULL THEN raw_ts END, timestamp '{RUN_TS}') AS processed_on FROM bronze")
def stamp_processed(spark, sf_dir):
    rows = _bronze(spark, sf_dir).withColumn("processed_on", F.when(F.col("url").isNotNull(), F.col("raw_ts")))
    return stamp(rows, F.lit(RUN_TS)).select("event_id", "processed_on")


@_register(f"SELECT event_id, ts FROM events WHERE ts > timestamp '{MARK}'")
def incremental_scan(spark, sf_dir):
    """Two datasets, of which the second arrives after the mark has been set to the newest file."""
    lake, events = _lake(spark), _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "ts")
    newer = F.coalesce(F.col("ts") > _ts(MARK), F.lit(False))
    events.where(~newer).write.parquet(f"{lake.bronze}/old.parquet")
    mark = newest(spark, lake.bronze).modified_ms
    time.sleep(0.01)  # files are told apart by milliseconds
    events.where(newer).write.parquet(f"{lake.bronze}/new.parquet")
    (rows,) = scan(spark, datasets(spark, lake.bronze, mark)).frames
    return rows.select(F.col("id").alias("event_id"), "ts")


@_register(f"WITH bronze AS ({BRONZE}) SELECT event_id, timestamp FROM bronze ORDER BY timestamp DESC NULLS LAST, event_id")
def sort_desc(spark, sf_dir):
    rows = _bronze(spark, sf_dir).withColumn("post_id", F.col("event_id"))
    return newest_first(rows).select("event_id", "timestamp")


# --- union, dedup, upsert ---------------------------------------------------


@_register("SELECT event_id AS id, event_type AS label, cast(NULL AS double) AS amount FROM events UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders")
def union_diagonal(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("label"))
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    return diagonal_union([events, orders])


@_register("""SELECT cast(event_id AS varchar) AS id, cast(event_id % 7 AS double) AS amount, cast(cast(ts AS date) AS timestamp) AS day, cast(event_id % 2 AS int) AS flag, cast(event_id % 3 AS double) AS tag, cast(user_id AS bigint) AS owner,
        event_type AS note_a, cast(NULL AS double) AS note_b, cast(event_id % 5 AS double) AS price FROM events
    UNION ALL SELECT concat('o', o_orderkey), cast(o_totalprice AS double), cast(o_orderdate AS timestamp), cast(o_orderkey % 9 AS int), cast(o_orderkey AS double) / 2, cast(o_custkey AS bigint),
        NULL, cast(o_orderkey % 4 AS double), cast(o_orderkey % 4 AS double) / 4 FROM orders
    UNION ALL SELECT cast(c_custkey AS varchar), NULL, NULL, NULL, NULL, cast(c_custkey AS bigint), c_name, cast(c_nationkey AS double), NULL FROM customer""")
def union_drift(spark, sf_dir):
    """Three frames whose types drift: numbers and text, integers, decimals and doubles, dates and timestamps, arrays, structs, and missing columns.

    Keys keep the types of their tables, since larger tables have keys that narrower types don't hold.
    """
    events = _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), (F.col("event_id") % 7).cast("int").alias("amount"), F.col("ts").cast("date").alias("day"), (F.col("event_id") % 2 == 1).alias("flag"),
        F.array((F.col("event_id") % 3).cast("int")).alias("tags"), F.struct(F.col("user_id").alias("owner"), F.col("event_type").alias("note_a")).alias("more"), (F.col("event_id") % 5).alias("price"),
    )
    orders = _table(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_totalprice").cast("double").alias("amount"), F.col("o_orderdate").cast("timestamp_ntz").alias("day"), (F.col("o_orderkey") % 9).cast("int").alias("flag"),
        F.array(F.col("o_orderkey").cast("double") / 2).alias("tags"), F.struct(F.col("o_custkey").cast("long").alias("owner"), (F.col("o_orderkey") % 4).cast("double").alias("note_b")).alias("more"),
        ((F.col("o_orderkey") % 4).cast("decimal(5,2)") / 4).cast("decimal(5,2)").alias("price"),
    )
    customer = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.struct(F.col("c_nationkey").alias("note_b"), F.col("c_custkey").alias("owner"), F.col("c_name").alias("note_a")).alias("more"), F.lit(None).alias("flag"))
    rows = diagonal_union([events, orders, customer])
    return rows.select("id", "amount", "day", "flag", F.get("tags", F.lit(0)).alias("tag"), "more.owner", "more.note_a", "more.note_b", F.col("price").cast("double").alias("price"))


@_register(f"{_POSTS} SELECT post_id, event_id, shortcode, url, caption, owner_id, owner_username, likes_count, timestamp, source_dataset FROM posts")
def dedup_latest(spark, sf_dir):
    return _posts(spark, sf_dir).select("post_id", "event_id", "shortcode", "url", "caption", "owner_id", "owner_username", "likes_count", "timestamp", "source_dataset")


@_register(f"""WITH bronze AS ({BRONZE}), posts AS (SELECT DISTINCT ON (post_id) * FROM bronze ORDER BY post_id, raw_ts DESC NULLS LAST, source_dataset DESC, event_id)
    SELECT d.source_dataset, cast(count(p.post_id) AS int) AS post_count FROM (SELECT DISTINCT source_dataset FROM bronze) d LEFT JOIN posts p ON p.source_dataset = d.source_dataset GROUP BY 1""")
def progress_counts(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    return progress(_latest(bronze, "raw_ts"), bronze.select("source_dataset"))


@_register("""SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN concat('new ', c_name) ELSE c_name END AS name FROM customer
    UNION ALL SELECT c_custkey + 1000000, c_name FROM customer WHERE c_custkey % 10 = 0""")
def upsert_replace(spark, sf_dir):
    customer, source = _customers(spark, sf_dir)
    return upsert(customer, source, ["id"])


def _customers(spark, sf_dir):
    """(stored customers, changed and added ones)."""
    customer = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    changed = customer.where("id % 3 = 0").select(F.concat(F.lit("new "), "name").alias("name"), "id")
    added = customer.where("id % 10 = 0").select("name", (F.col("id") + 1_000_000).alias("id"))
    return customer, changed.unionByName(added)


@_register(_REGISTRY["upsert_replace"][1])
def state_upsert(spark, sf_dir):
    """The same upsert into a stored table, by buckets."""
    customer, source = _customers(spark, sf_dir)
    table = StateTable(spark, f"{_lake(spark).state}/customer", customer.schema, ("id",), buckets=4)
    table.replace(customer)
    table.upsert(source)
    return table.read(required=True)


@_register(f"{_POSTS} SELECT post_id, event_id, shortcode, url, caption, owner_id, owner_username, likes_count, timestamp, source_dataset FROM posts")
def state_increments(spark, sf_dir):
    """Posts merged into a stored table in two halves and a small rest: delta runs over a base, in buckets that grow."""
    columns = ["post_id", "event_id", "shortcode", "url", "caption", "owner_id", "owner_username", "likes_count", "timestamp", "source_dataset"]
    rows = _bronze(spark, sf_dir).select(*columns)
    table = StateTable(spark, f"{_lake(spark).state}/posts", rows.schema, ("post_id",), buckets=2, bucket_rows=1500)
    # Each part holds rows of posts that the parts before have, too.
    part = F.when(F.col("event_id") % 50 == 49, 2).otherwise(F.pmod(F.xxhash64("event_id"), F.lit(2)))
    for k in range(3):
        table.merge(_latest(rows.where(part == k)), lambda old, new: _latest(old.unionByName(new)), unique=True)
    return table.read(required=True)


@_register("""WITH known AS (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0) SELECT o_orderkey AS id, o_custkey AS parent, cast(0 AS int) AS state FROM orders WHERE o_custkey IN (SELECT c_custkey FROM known)
    UNION ALL SELECT NULL, o_custkey, NULL FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM known) GROUP BY o_custkey""")
def state_constraints(spark, sf_dir):
    """Orders with a customer as a foreign key and a default, and the customers that are missing: a commit that names one is refused whole."""
    root = _lake(spark).state
    customer = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("parent"))
    parents = StateTable(spark, f"{root}/customer", customer.schema, ("id",), buckets=4)
    parents.replace(customer.where("id % 5 <> 0"))
    schema = orders.withColumn("state", F.lit(None).cast("int")).schema
    children = StateTable(spark, f"{root}/orders", schema, ("id",), buckets=4, constraints=Constraints(("parent", "state"), {"state": 0}, ("parent", parents)))
    try:
        children.upsert(orders)
    except MissingParent:
        wanted = orders.select(F.col("parent").alias("id")).distinct()
        missing = parents.missing_keys(wanted, wanted.count()).select(F.col("id").alias("parent"))
        children.upsert(orders.join(missing, "parent", "left_anti"))
        return children.read().unionByName(missing, allowMissingColumns=True)
    return children.read()


@_register(f"{_POSTS} SELECT source_dataset, count(*) AS n_rows FROM posts WHERE NOT coalesce(likes_count % 3 = 0, false) GROUP BY 1")
def state_statistics(spark, sf_dir):
    """Rows by dataset as the commits noted them: three merges, of which the later ones move posts to other datasets, and a deletion."""
    table, posts = State(spark, _lake(spark).state, buckets=4).table("silver_ig_posts"), _posts(spark, sf_dir)
    table.merge(posts.where("event_id % 10 < 9").withColumn("source_dataset", F.lit("before")), lambda old, new: new)
    table.merge(posts.where("event_id % 10 <> 0"), lambda old, new: new)
    table.merge(posts.where("event_id % 10 = 0"), lambda old, new: new)
    table.delete_where("likes_count % 3 = 0")
    return table.counts()


@_register(f"{_POSTS} SELECT post_id, shortcode, url, caption, owner_id, owner_username, likes_count, timestamp, source_dataset FROM posts")
def state_source(spark, sf_dir):
    """Stored posts, upserted in two steps, through the Spark source of state tables."""
    state, posts = State(spark, _lake(spark).state, buckets=4), _posts(spark, sf_dir)
    table = state.table("silver_ig_posts")
    table.upsert(posts.where("event_id % 10 < 9").withColumn("caption", F.lit("before")))
    table.upsert(posts.where("event_id % 10 <> 0"))
    table.upsert(posts.where("event_id % 10 = 0"))
    spark.dataSource.register(StateSource)
    spark.conf.set(PUSHDOWN, "true")
    stored = spark.read.format(STATE_FORMAT).option("root", state.root).option("table", "silver_ig_posts").load()
    return stored.select("post_id", "shortcode", "url", "caption", "owner_id", "owner_username", "likes_count", "timestamp", "source_dataset")


# --- enrichment -------------------------------------------------------------


@_register(f"WITH bronze AS ({BRONZE}) SELECT event_id, raw_ts FROM bronze WHERE raw_ts > coalesce((SELECT timestamp '{MARK}' WHERE 'gold_ig' = 'gold_ig'), timestamp '1970-01-01')")
def pending_by_watermark(spark, sf_dir):
    marks = spark.createDataFrame([("gold_ig", MARK), ("silver_ig", RUN_TS)], "name string, timestamp string").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return enrich.pending(_bronze(spark, sf_dir), marks, "gold_ig", "raw_ts").select("event_id", "raw_ts")


@_register(f"WITH bronze AS ({BRONZE}) SELECT event_id, raw_ts FROM bronze ORDER BY raw_ts, event_id LIMIT 10")
def pending_batch(spark, sf_dir):
    return enrich.batch(_bronze(spark, sf_dir), 10, "raw_ts", "event_id").select("event_id", "raw_ts")


@_register(f"""{_POSTS} SELECT post_id, 'instagram' AS domain, 'Empty caption' AS error, cast(0 AS int) AS attempts, timestamp '{RUN_TS}' AS failed_at, 'skipped' AS status
    FROM posts WHERE regexp_replace(caption, '\\s', '', 'g') = ''""")
def dead_letter_route(spark, sf_dir):
    return enrich.skipped_letters(_posts(spark, sf_dir), F.lit(RUN_TS))


class _Echo:
    """A deterministic analyzer: fails on one caption, else answers with its length."""

    def analyze(self, prompt: str) -> str:
        if prompt.endswith("error"):
            raise RuntimeError("no answer")
        return json.dumps({"admirality": "B1", "length": len(prompt) - len(enrich.PROMPT)})


@_register(f"""{_POSTS} SELECT post_id, event_type_failed IS NULL AS ok, CASE WHEN event_type_failed IS NULL THEN concat('{{"admirality": "B1", "length": ', cast(length(caption) AS varchar), '}}') END AS result_json,
    event_type_failed AS error, cast(CASE WHEN event_type_failed IS NULL THEN 1 ELSE 3 END AS int) AS attempts
    FROM (SELECT *, CASE WHEN caption LIKE '%error' THEN 'no answer' END AS event_type_failed FROM posts) WHERE regexp_replace(caption, '\\s', '', 'g') <> ''""")
def enrich_posts(spark, sf_dir):
    return enrich.analyze(_posts(spark, sf_dir), _Echo, backoff=0.0).drop("retry_after", "pauses")


class _Metered(_Echo):
    """Takes 200 calls, and then says that its quota is used up."""

    calls = 0

    def analyze(self, prompt):
        self.calls += 1
        if self.calls > 200:
            raise enrich.QuotaExceeded(retry_after=0.0)
        return super().analyze(prompt)


@_register(f"""{_POSTS} SELECT post_id, caption LIKE '%error' AS buried FROM posts WHERE regexp_replace(caption, '\\s', '', 'g') <> ''
    UNION ALL SELECT post_id, true FROM posts WHERE regexp_replace(coalesce(caption, ''), '\\s', '', 'g') = ''""")
def gold_quota(spark, sf_dir):
    """Posts through an analyzer whose quota ends: all are answered or buried in the end, none because of the quota."""
    state = State(spark, _lake(spark).state, buckets=4)
    state.table("silver_ig_posts").replace(_posts(spark, sf_dir).withColumn("processed_on", _ts(RUN_TS)))
    gold = run_gold(state, _Metered, dt.datetime(2024, 7, 2), EnrichConfig(batch_limit=None, backoff_seconds=0.0, quota_pauses=10**6))
    return gold.select("post_id", F.lit(False).alias("buried")).unionByName(state.table("dead_letter").read().select("post_id", F.lit(True).alias("buried")))


@_register(f"SELECT coalesce(max(ts), timestamp '{RUN_TS}') AS mark FROM events")
def watermark_seed(spark, sf_dir):
    return seed_mark(_table(spark, sf_dir, "events"), "ts", dt.datetime(2024, 7, 1))


# --- serving ----------------------------------------------------------------


def _dim(spark, sf_dir):
    empty = spark.createDataFrame([], schemas.DIM_PROFILE)
    return apply_names(empty, observed_names(_posts(spark, sf_dir)), F.lit(RUN_TS))


_DIM = f"""names AS (SELECT owner_id, owner_username, max(timestamp) AS last_seen FROM posts WHERE owner_id IS NOT NULL GROUP BY 1, 2),
    seq AS (SELECT *, row_number() OVER (PARTITION BY owner_id ORDER BY last_seen NULLS FIRST, owner_username NULLS FIRST) AS n, count(*) OVER (PARTITION BY owner_id) AS total FROM names),
    dim AS (SELECT cast(row_number() OVER (ORDER BY owner_id, n) AS int) AS profile_key, owner_id, owner_username, 'instagram' AS channel, timestamp '{RUN_TS}' AS effective_from,
        CASE WHEN n < total THEN timestamp '{RUN_TS}' END AS effective_to, n = total AS is_current FROM seq)"""


_ORDER = "PARTITION BY owner_id ORDER BY last_seen NULLS FIRST, owner_username NULLS FIRST"
_CHAIN = f"""names1 AS (SELECT owner_id, owner_username, max(timestamp) AS last_seen FROM posts WHERE owner_id IS NOT NULL AND timestamp <= timestamp '{MARK}' GROUP BY 1, 2),
    seq1 AS (SELECT *, row_number() OVER ({_ORDER}) AS n, count(*) OVER (PARTITION BY owner_id) AS total FROM names1),
    dim1 AS (SELECT cast(row_number() OVER (ORDER BY owner_id, n) AS int) AS profile_key, owner_id, owner_username, 'instagram' AS channel, timestamp '{MARK}' AS effective_from,
        CASE WHEN n < total THEN timestamp '{MARK}' END AS effective_to, n = total AS is_current FROM seq1),
    names2 AS (SELECT p.owner_id, p.owner_username, max(timestamp) AS last_seen, any_value(c.owner_id) IS NOT NULL AS known, any_value(c.owner_username) AS current_name
        FROM posts p LEFT JOIN dim1 c ON c.owner_id = p.owner_id AND c.is_current WHERE p.owner_id IS NOT NULL GROUP BY 1, 2),
    seq2 AS (SELECT *, row_number() OVER w AS seq, lag(owner_username) OVER w AS prev, last_value(owner_username) OVER ({_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS newest
        FROM names2 WINDOW w AS ({_ORDER})),
    opened AS (SELECT *, row_number() OVER (ORDER BY owner_id, seq) AS number, seq = max(seq) OVER (PARTITION BY owner_id) AS is_last FROM seq2
        WHERE NOT (known AND newest IS NOT DISTINCT FROM current_name) AND CASE WHEN seq > 1 THEN owner_username IS DISTINCT FROM prev ELSE NOT known OR owner_username IS DISTINCT FROM current_name END)
    SELECT profile_key, owner_id, owner_username, channel, effective_from, CASE WHEN is_current AND owner_id IN (SELECT owner_id FROM opened) THEN timestamp '{RUN_TS}' ELSE effective_to END AS effective_to,
        is_current AND owner_id NOT IN (SELECT owner_id FROM opened) AS is_current FROM dim1
    UNION ALL SELECT cast((SELECT coalesce(max(profile_key), 0) FROM dim1) + number AS int), owner_id, owner_username, 'instagram', timestamp '{RUN_TS}', CASE WHEN NOT is_last THEN timestamp '{RUN_TS}' END, is_last FROM opened"""


@_register(f"{_POSTS}, {_DIM} SELECT * FROM dim")
def scd2_chain(spark, sf_dir):
    return _dim(spark, sf_dir)


@_register(f"{_POSTS}, {_CHAIN}")
def scd2_stored(spark, sf_dir):
    """Two runs over a stored dimension: the second closes rows of the first, and opens others."""
    dim, posts = State(spark, _lake(spark).state, buckets=4).table("dim_profile"), _posts(spark, sf_dir)
    for part, run_ts in ((posts.where(F.col("timestamp") <= _ts(MARK)), MARK), (posts, RUN_TS)):
        dim.upsert(changed_rows(dim.read(), observed_names(part), F.lit(run_ts)))
    return dim.read(required=True)


@_register(f"{_POSTS} SELECT DISTINCT owner_id, owner_username FROM posts WHERE owner_id IS NOT NULL")
def distinct_profiles(spark, sf_dir):
    return observed_names(_posts(spark, sf_dir)).select("owner_id", "owner_username")


@_register("SELECT coalesce(max(c_custkey), 0) AS max_key FROM customer", "max_key")
def largest_key(spark, sf_dir):
    return max_key(_table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "profile_key"))


_VIEW_COLUMNS = "post_id, shortcode, url, caption, owner_id, owner_username, likes_count, timestamp, source_dataset, result_json, gold_analysed_at, profile_key, channel, effective_from, effective_to, is_current"


@_register(f"""{_POSTS}, {_DIM}, gold AS (SELECT cast(doc_id AS varchar) AS post_id, concat('{{"quality":', cast(quality AS varchar), '}}') AS result_json FROM labels)
    SELECT p.post_id, shortcode, url, caption, p.owner_id, p.owner_username, likes_count, timestamp, source_dataset, result_json,
        CASE WHEN g.post_id IS NOT NULL THEN timestamp '{RUN_TS}' END AS gold_analysed_at, profile_key, channel, effective_from, effective_to, is_current
    FROM posts p LEFT JOIN gold g ON p.post_id = g.post_id LEFT JOIN dim d ON p.owner_id = d.owner_id AND d.is_current""", "analytics_view")
def analytics_view_rows(spark, sf_dir):
    posts = add_defaults(_posts(spark, sf_dir)).withColumn("comments_count", F.lit(None).cast("int"))
    gold = _gold(spark, sf_dir).withColumn("post_id", F.col("post_id").cast("string"))
    return analytics_view(posts, gold, _dim(spark, sf_dir)).select(*(c.strip() for c in _VIEW_COLUMNS.split(",")))


@_register("""SELECT cast(strftime(d, '%Y%m%d') AS int) AS date_key, cast(d AS date) AS date, cast(year(d) AS int) AS year, cast(quarter(d) AS int) AS quarter, cast(month(d) AS int) AS month,
    cast(day(d) AS int) AS day, cast(isodow(d) AS int) AS day_of_week, cast(week(d) AS int) AS week, isodow(d) >= 6 AS is_weekend, n AS n_orders
    FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders)::timestamp, (SELECT max(o_orderdate) FROM orders)::timestamp, interval 1 day)) AS d)
    LEFT JOIN (SELECT cast(o_orderdate AS date) AS day_, count(*) AS n FROM orders GROUP BY 1) o ON day_ = cast(d AS date)""")
def dim_time(spark, sf_dir):
    """The dimension over the days of the orders, stored and read again, with the orders of each day."""
    days = _table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    first, last = days.agg(F.min("date"), F.max("date")).first()
    dim = run_dim_time(State(spark, _lake(spark).state), first, last)
    return dim.join(days.groupBy("date").agg(F.count("*").alias("n_orders")), "date", "left").select(*dim.columns, "n_orders")


@_register("""SELECT cast(doc_id AS varchar) AS post_id, lang AS shortcode, cast(NULL AS varchar) AS url, timestamp '2024-07-01' AS processed_on FROM documents""")
def migrate_rename(spark, sf_dir):
    old = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("post_id"), F.col("lang").alias("shortcode"), _ts(RUN_TS).alias("silvered_at"))
    return migrated_posts(old).select("post_id", "shortcode", "url", "processed_on")


# --- checks -----------------------------------------------------------------

_INTERVALS = """SELECT cast(user_id AS varchar) AS owner_id, cast(event_id AS int) AS profile_key, ts AS effective_from,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts + interval 1 hour * (event_id % 50 - 5) END AS effective_to FROM events WHERE ts IS NOT NULL"""


def _intervals(spark, sf_dir):
    """Rows like the profile dimension's, with every kind of violation."""
    events = _table(spark, sf_dir, "events").where("ts IS NOT NULL")
    end = F.when(F.col("event_id") % 13 != 0, F.expr("timestampadd(HOUR, cast(event_id % 50 - 5 AS int), cast(ts AS timestamp_ntz))"))
    return events.select(F.col("user_id").cast("string").alias("owner_id"), F.col("event_id").cast("int").alias("profile_key"), F.col("ts").cast("timestamp_ntz").alias("effective_from"), end.alias("effective_to"))


@_register(f"""WITH d AS ({_INTERVALS}) SELECT a.owner_id, a.profile_key AS key_a, b.profile_key AS key_b FROM d a JOIN d b ON a.owner_id = b.owner_id AND a.profile_key < b.profile_key
    AND a.effective_from < coalesce(b.effective_to, timestamp '9999-12-31') AND b.effective_from < coalesce(a.effective_to, timestamp '9999-12-31')""")
def check_overlap(spark, sf_dir):
    return checks.overlapping_intervals(_intervals(spark, sf_dir))


@_register(f"WITH d AS ({_INTERVALS}) SELECT * FROM d WHERE effective_to IS NOT NULL AND effective_from > effective_to")
def check_range_valid(spark, sf_dir):
    return checks.inverted_ranges(_intervals(spark, sf_dir))


@_register(f"""WITH d AS ({_INTERVALS}), p AS (SELECT *, lag(effective_to) OVER (PARTITION BY owner_id ORDER BY effective_from, profile_key) AS previous_to FROM d)
    SELECT * FROM p WHERE previous_to IS NOT NULL AND effective_from <> previous_to""")
def check_no_gaps(spark, sf_dir):
    return checks.gaps(_intervals(spark, sf_dir))


@_register(f"WITH bronze AS ({BRONZE}) SELECT count(*) AS total, count(DISTINCT post_id) AS distinct_keys FROM bronze")
def check_no_duplicates(spark, sf_dir):
    return checks.duplicate_counts(_bronze(spark, sf_dir), "post_id")


@_register(f"WITH bronze AS ({BRONZE}) SELECT count(*) - count(url) AS n_null FROM bronze")
def check_null_ids(spark, sf_dir):
    return checks.null_count(_bronze(spark, sf_dir), "url")


@_register(f"{_POSTS} SELECT (SELECT count(*) FROM posts) AS n_part, (SELECT count(*) FROM bronze) AS n_whole, (SELECT count(*) FROM posts) <= (SELECT count(*) FROM bronze) AS bounded")
def check_row_bound(spark, sf_dir):
    return checks.row_bound(_posts(spark, sf_dir), _bronze(spark, sf_dir))


@_register("SELECT 'events' AS name, count(*) > 0 AS passed FROM events")
def check_has_rows(spark, sf_dir):
    result = checks.has_rows("events", _table(spark, sf_dir, "events"))
    return spark.createDataFrame([(result.name, result.passed)], "name string, passed boolean")


_CODES = """SELECT event_id AS post_id, cast(event_id % 4 AS int) AS schema_version, CASE WHEN event_id % 9 = 0 THEN 'no json' ELSE concat('{"admirality":"', chr(cast(65 + event_id % 4 AS int)), cast(event_id % 8 AS varchar), '"',
    CASE WHEN event_id % 5 < 4 THEN ',"educational_json":{"summary":"s"}' ELSE ',"educational_json":"s"' END,
    CASE WHEN event_id % 3 < 2 THEN ',"actionable_json":{"summary":"t"}' ELSE ',"actionable_json":{"summary":""}' END, '}') END AS result_json FROM events"""


def _documents(spark, sf_dir):
    """Analyses with valid and invalid codes, documents and versions."""
    e = F.col("event_id")
    text = F.concat(
        F.lit('{"admirality":"'), F.expr("chr(65 + event_id % 4)"), (e % 8).cast("string"), F.lit('"'),
        F.when(e % 5 < 4, F.lit(',"educational_json":{"summary":"s"}')).otherwise(F.lit(',"educational_json":"s"')),
        F.when(e % 3 < 2, F.lit(',"actionable_json":{"summary":"t"}')).otherwise(F.lit(',"actionable_json":{"summary":""}')), F.lit("}"),
    )
    return _table(spark, sf_dir, "events").select(e.alias("post_id"), (e % 4).cast("int").alias("schema_version"), F.when(e % 9 == 0, F.lit("no json")).otherwise(text).alias("result_json"))


_LIST = ", ".join(f"'{c}'" for c in schemas.ADMIRALITY_CODES)


@_register(f"WITH g AS ({_CODES}) SELECT post_id FROM g WHERE NOT coalesce(CASE WHEN json_valid(result_json) THEN json_extract_string(result_json, '$.admirality') END IN ({_LIST}), false)")
def check_valid_codes(spark, sf_dir):
    return checks.invalid_codes(_documents(spark, sf_dir)).select("post_id")


@_register(f"""WITH g AS ({_CODES}), v AS (SELECT post_id, json_valid(result_json) AS ok, CASE WHEN json_valid(result_json) THEN result_json END AS j FROM g)
    SELECT post_id FROM v WHERE NOT (ok AND coalesce(json_type(j, '$.educational_json') = 'OBJECT' AND json_extract_string(j, '$.educational_json.summary') <> '', false)
        AND coalesce(json_type(j, '$.actionable_json') = 'OBJECT' AND json_extract_string(j, '$.actionable_json.summary') <> '', false))""")
def check_json(spark, sf_dir):
    return checks.incomplete_documents(_documents(spark, sf_dir)).select("post_id")


@_register(f"WITH g AS ({_CODES}) SELECT post_id, json_valid(result_json) AS valid FROM g")
def json_validity(spark, sf_dir):
    return _documents(spark, sf_dir).select("post_id", json_valid(F.col("result_json")).alias("valid"))


@_register(f"WITH g AS ({_CODES}) SELECT post_id, schema_version FROM g WHERE schema_version <> 3")
def check_schema_version(spark, sf_dir):
    return checks.outdated(_documents(spark, sf_dir)).select("post_id", "schema_version")


@_register(f"{_POSTS} SELECT post_id FROM posts WHERE regexp_replace(coalesce(caption, ''), '\\s', '', 'g') = ''")
def filter_blank(spark, sf_dir):
    return _posts(spark, sf_dir).where(is_blank(F.col("caption"))).select("post_id")


#: Columns and types that users of the state rely on, written out apart from `schemas`.
_CONTRACT = """
    silver_ig_posts: post_id string, shortcode string, url string, caption string, owner_id string, owner_username string, likes_count int, comments_count int, video_play_count int, video_view_count int, timestamp timestamp_ntz, hashtags string, meta_data string, has_engagement_bait boolean, media_files string, media_count int, source_dataset string, processed_on timestamp_ntz
    silver_ig_progress: source_dataset string, post_count int, completed_at timestamp_ntz
    watermarks: name string, timestamp timestamp_ntz, config_hash string
    gold_ig_analyses: post_id string, schema_version int, result_json string, analysed_at timestamp_ntz
    dead_letter: post_id string, domain string, error string, attempts int, failed_at timestamp_ntz, status string
    dim_profile: profile_key int, owner_id string, owner_username string, channel string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean
    dim_time: date_key int, date date, year int, quarter int, month int, day int, day_of_week int, week int, is_weekend boolean
"""
_CONTRACT_ROWS = [(t, i, *c.split(" ")) for line in _CONTRACT.strip().splitlines() for t, _, columns in [line.strip().partition(": ")] for i, c in enumerate(columns.split(", "), 1)]


@_register("SELECT v.*, n.n_rows FROM (VALUES " + ", ".join(f"('{t}', cast({i} AS int), '{c}', '{k}')" for t, i, c, k in _CONTRACT_ROWS) + """) v(table_name, position, column_name, type_name)
    JOIN (SELECT 'silver_ig_posts' AS table_name, (SELECT count(DISTINCT floor(event_id / 5)) FROM events) AS n_rows UNION ALL SELECT 'silver_ig_progress', (SELECT count(DISTINCT source) FROM documents)
    UNION ALL SELECT 'gold_ig_analyses', (SELECT count(DISTINCT doc_id) FROM labels) UNION ALL SELECT 'dead_letter', (SELECT count(*) FROM documents)
    UNION ALL SELECT 'watermarks', (SELECT count(DISTINCT lang) FROM documents) UNION ALL SELECT 'dim_profile', (SELECT count(*) FROM customer) UNION ALL SELECT 'dim_time', (SELECT count(DISTINCT cast(o_orderdate AS date)) FROM orders)) n
    ON n.table_name = v.table_name""")
def schema_contract(spark, sf_dir):
    """Columns of the stored state tables, as Spark infers them from files that hold rows of the given tables, and the rows of each."""
    state = State(spark, _lake(spark).state)
    documents, orders = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "orders")
    stamp_ = _ts(RUN_TS)
    sources = {
        "silver_ig_posts": _posts(spark, sf_dir),
        "silver_ig_progress": documents.groupBy(F.col("source").alias("source_dataset")).agg(F.count("*").alias("post_count")),
        "gold_ig_analyses": _gold(spark, sf_dir).dropDuplicates(["post_id"]),
        "dead_letter": documents.select(F.col("doc_id").alias("post_id"), F.col("lang").alias("domain"), F.substring("text", 1, 20).alias("error"), F.lit(1).alias("attempts"), stamp_.alias("failed_at"), F.lit("pending").alias("status")),
        "watermarks": documents.select(F.col("lang").alias("name")).distinct().select("name", stamp_.alias("timestamp")),
        "dim_profile": _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("profile_key"), F.col("c_name").alias("owner_username"), F.lit(True).alias("is_current")),
        "dim_time": orders.select(F.date_format("o_orderdate", "yyyyMMdd").alias("date_key"), F.col("o_orderdate").alias("date")).distinct(),
    }
    found = []
    for name, rows in sources.items():
        state.table(name).replace(rows)
        stored = spark.read.parquet(f"{state.root}/{name}/_v=1").drop(BUCKET)
        columns = F.array(*(F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(kind).alias("type_name")) for i, (c, kind) in enumerate(stored.dtypes, 1)))
        found.append(stored.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), F.explode(columns).alias("c"), "n_rows").select("table_name", "c.*", "n_rows"))
    return reduce(DataFrame.unionAll, found)


@_register(f"""WITH d AS ({_INTERVALS}), t AS (SELECT owner_id, profile_key, effective_from AS low, coalesce(effective_to, timestamp '9999-12-31') AS high FROM d)
    SELECT DISTINCT a.owner_id FROM t a JOIN t b ON a.owner_id = b.owner_id AND a.profile_key <> b.profile_key AND a.low < b.high AND b.low < a.high""")
def check_overlapping_owners(spark, sf_dir):
    """Owners with rows that overlap an earlier one, as the check counts them: by sorting, without pairs."""
    return checks.overlapping_rows(_intervals(spark, sf_dir)).select("owner_id").distinct()


def _damage(spark: SparkSession, path: str) -> None:
    """Invert some bytes of a Parquet file, so that it keeps its footer and loses a page."""
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    raw = bytearray(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    stream.close()
    raw[4:68] = bytes(b ^ 0xFF for b in raw[4:68])
    out = fs.create(p, True)
    out.write(raw)
    out.close()


@_register("""SELECT CAST(event_id AS VARCHAR) AS post_id, concat('caption ', event_type) AS caption, concat('good_', cast(event_id % 3 AS varchar)) AS source_dataset FROM events WHERE event_id % 4 < 3
    UNION ALL SELECT concat('q:', 'bad'), 'rows are missing', 'quarantine' FROM (SELECT 1) x""")
def silver_quarantine(spark, sf_dir):
    """Events as datasets, one with a damaged part: the others come in whole, of that one nothing, and it is kept back."""
    lake, state = _lake(spark), State(spark, _lake(spark).state, buckets=2)
    events = _table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), F.concat(F.lit("caption "), "event_type").alias("caption"), "event_id")
    for k in range(3):
        events.where((F.col("event_id") % 4 < 3) & (F.col("event_id") % 3 == k)).drop("event_id").write.parquet(f"{lake.bronze}/good_{k}.parquet")
    bad = f"{lake.bronze}/bad.parquet"
    events.where("event_id % 4 = 3").drop("event_id").repartition(3).write.parquet(bad)
    part = next(f for f in listing(spark, bad) if f.name.endswith(".parquet"))
    _damage(spark, part.path)
    posts = run_silver(lake, state, dt.datetime(2024, 7, 1)).select("post_id", "caption", "source_dataset")
    kept = state.table("bronze_quarantine").read().select(F.concat(F.lit("q:"), "dataset_id").alias("post_id"), F.regexp_extract("reason", "(rows are missing)", 1).alias("caption"), F.lit("quarantine").alias("source_dataset"))
    return posts.unionByName(kept)


QUERIES = {name: f for name, (f, _) in _REGISTRY.items()}
ORACLES = {name: oracle for name, (_, oracle) in _REGISTRY.items() if oracle}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated posts with their analysis and their owner's current profile."""
    return analytics_view_rows(spark, sf_dir)
