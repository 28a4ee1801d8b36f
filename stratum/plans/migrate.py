"""Imports and migrations of earlier layouts."""

from __future__ import annotations

import datetime as dt
import json
import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lenient_timestamp, list_to_json
from ..operators.dedup import latest_per_key
from ..operators.normalize import fit_schema
from ..schemas import DEAD_LETTER, GOLD, OLD_GOLD, OLD_SILVER, SILVER
from ..sources.files import create_new, delete, exists, listing, read_text, write_text, written
from ..sources.ndjson import scan_documents, scan_strict
from ..sources.state import State

log = logging.getLogger(__name__)

_POST = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "shortCode", "url", "caption", "ownerId", "ownerUsername", "timestamp", "inputUrl")]
    + [T.StructField(n, T.LongType()) for n in ("likesCount", "commentsCount", "videoViewCount")]
    + [T.StructField("hashtags", T.ArrayType(T.StringType()))]
)
_ANALYSIS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("post_id", "status", "error", "analysed_at", "result_json")] + [T.StructField("schema_version", T.LongType()), T.StructField("attempts", T.LongType())]
)


def import_ndjson(state: State, raw: str, bronze: str) -> int:
    """Each `<id>.jsonl` of a folder becomes the dataset `<id>.parquet` with its sidecar; number of datasets written.

    Datasets that are there as a whole are kept, half-written ones replaced.  A file with a line that is no JSON is
    left out as a whole, and so is an empty one.
    """
    spark, count = state.spark, 0
    for f in listing(spark, raw):
        dest = f"{bronze.rstrip('/')}/{f.stem}.parquet"
        if not f.name.endswith(".jsonl") or written(spark, dest):
            continue
        try:
            df = scan_strict(spark, f.path)
            if not df.columns:
                continue
            df.write.mode("overwrite").parquet(dest)
        except Exception as problem:  # noqa: BLE001  one bad file doesn't end the import
            log.warning("skipping %s: %s", f.path, str(problem).splitlines()[0])
            delete(spark, dest)
            continue
        meta = read_text(spark, f"{f.path}.meta") or read_text(spark, f"{f.path[: -len('.jsonl')]}.meta")
        if meta is not None:
            write_text(spark, f"{dest}.meta", meta)
        count += 1
    return count


def import_documents(state: State, silver: str, gold: str, run_ts: dt.datetime) -> tuple[int, int]:
    """Upsert `<id>/post.json` and `<id>.json` documents into the tables of the first version; rows of both."""
    spark = state.spark
    posts = analyses = 0
    if exists(spark, silver):
        found = scan_documents(spark, f"{silver.rstrip('/')}/*/post.json", _POST).where("id IS NOT NULL")
        rows = fit_schema(
            found.select(
                F.col("id").alias("post_id"), F.col("shortCode").alias("shortcode"), "url", "caption", F.col("ownerId").alias("owner_id"), F.col("ownerUsername").alias("owner_username"),
                F.coalesce("likesCount", F.lit(0)).alias("likes_count"), F.coalesce("commentsCount", F.lit(0)).alias("comments_count"), F.coalesce("videoViewCount", F.lit(0)).alias("video_view_count"),
                lenient_timestamp(F.col("timestamp")).alias("timestamp"), list_to_json(F.col("hashtags")).alias("hashtags"), F.lit(False).alias("has_engagement_bait"), F.lit("[]").alias("media_files"),
                F.lit(0).alias("media_count"), F.coalesce("inputUrl", F.lit("")).alias("source_dataset"), F.lit(run_ts).cast("timestamp_ntz").alias("silvered_at"),
            ),
            OLD_SILVER,
        )
        table = state.table("silver_posts")
        rows = latest_per_key(rows, ["post_id"], [F.desc_nulls_last("timestamp"), F.desc_nulls_last("source_dataset")])
        table.upsert(rows)
        posts = found.agg(F.count("id")).first()[0]
        done = spark.createDataFrame([("migration_phase2", posts)], "source_dataset string, post_count int").withColumn("completed_at", F.lit(run_ts).cast("timestamp_ntz"))
        state.table("silver_progress").upsert(done)
    if exists(spark, gold):
        found = scan_documents(spark, f"{gold.rstrip('/')}/*.json", _ANALYSIS)
        rows = found.select(
            F.coalesce("post_id", "stem").alias("post_id"), F.coalesce("schema_version", F.lit(2)).cast("int").alias("schema_version"), F.coalesce("status", F.lit("completed")).alias("status"),
            F.coalesce("result_json", F.lit("{}")).alias("result_json"), "error", F.coalesce("attempts", F.lit(1)).cast("int").alias("attempts"), lenient_timestamp(F.col("analysed_at")).alias("analysed_at"),
        )
        rows = latest_per_key(fit_schema(rows, OLD_GOLD), ["post_id"], [F.desc_nulls_last("analysed_at")])
        state.table("gold_analyses").upsert(rows)
        analyses = found.agg(F.count(F.coalesce("post_id", "stem"))).first()[0]
    return posts, analyses


def run_import(state: State, raw: str, bronze: str, silver: str, gold: str, run_ts: dt.datetime, phases: tuple[int, ...] = (1, 2)) -> dict[str, object]:
    """The import by phases; a marker for each phase keeps it from running twice."""
    done: dict[str, object] = {}
    for phase in phases:
        marker = f"{state.root}/_import_phase{phase}.json"
        if exists(state.spark, marker):
            continue
        done[f"phase{phase}"] = import_ndjson(state, raw, bronze) if phase == 1 else import_documents(state, silver, gold, run_ts)
        create_new(state.spark, marker, json.dumps({"completed_at": run_ts.isoformat()}))
    return done


def migrated_posts(old: DataFrame) -> DataFrame:
    """Posts of the first version in today's schema."""
    return fit_schema(old.withColumnRenamed("silvered_at", "processed_on"), SILVER)


def migrated_analyses(old: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(completed analyses, dead letters of the others) of the first version."""
    completed = F.coalesce(F.col("status") == "completed", F.lit(False))
    others = old.where(~completed).select(
        "post_id", F.lit("instagram").alias("domain"), "error", "attempts", F.coalesce("analysed_at", F.lit("1970-01-01").cast("timestamp_ntz")).alias("failed_at"), F.lit("pending").alias("status")
    )
    return fit_schema(old.where(completed), GOLD), fit_schema(others, DEAD_LETTER)


def seed_mark(df: DataFrame, column: str, now: dt.datetime) -> DataFrame:
    """One row: the latest timestamp of a column, or now."""
    return df.agg(F.coalesce(F.max(column), F.lit(now).cast("timestamp_ntz")).alias("mark"))


def migrate(state: State, now: dt.datetime) -> None:
    """Tables of the first version become today's, once; marks are seeded from their data."""
    if state.exists("silver_posts") and not state.exists("silver_ig_posts"):
        state.table("silver_ig_posts").replace(migrated_posts(state.table("silver_posts").read()))
    if state.exists("gold_analyses") and not state.exists("gold_ig_analyses"):
        done, others = migrated_analyses(state.table("gold_analyses").read())
        state.table("gold_ig_analyses").replace(done)
        state.table("dead_letter").upsert(others)
    if state.exists("silver_progress") and not state.exists("silver_ig_progress"):
        state.table("silver_ig_progress").replace(state.table("silver_progress").read())
    for old in ("gold_analyses", "silver_posts", "silver_progress"):
        state.table(old).drop()
    for name, table, column in (("silver_ig", "silver_ig_progress", "completed_at"), ("gold_ig", "gold_ig_analyses", "analysed_at")):
        if state.exists(table):
            state.advance(name, seed_mark(state.table(table).read(), column, now).first()[0])
