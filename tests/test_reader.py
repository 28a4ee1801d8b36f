"""State tables as a Spark source, and the view over them."""

import random

from pyspark.sql import functions as F

from stratum.operators.views import analytics_view
from stratum.plans.serving import create_catalog_view
from stratum.schemas import DEAD_LETTER, DIM_PROFILE, GOLD, SILVER
from stratum.sources import state as S
from stratum.sources.reader import FORMAT, PUSHDOWN, StateSource, bucket_number, key_hash
from stratum.sources.state import State

from .helpers import T0


def rows(spark, schema, values: dict[str, list]):
    names = list(values)
    made = spark.createDataFrame(list(zip(*values.values(), strict=True)), ", ".join(f"{n} {schema[n].dataType.simpleString()}" for n in names))
    return made.select(*(F.col(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))


def posts(spark, ids, caption):
    return rows(spark, SILVER, {"post_id": [str(i) for i in ids], "caption": [caption] * len(ids), "owner_id": [f"o{i % 3}" for i in ids], "timestamp": [T0] * len(ids)})


def load(spark, state, table):
    spark.dataSource.register(StateSource)
    spark.conf.set(PUSHDOWN, "true")
    return spark.read.format(FORMAT).option("root", state.root).option("table", table).load()


def test_keys_hash_as_in_spark(spark):
    rng = random.Random(1)
    data = [("".join(rng.choice("aä漢\U0001f600 xyz") for _ in range(rng.randrange(0, 70))), rng.randrange(-(2**31), 2**31), rng.randrange(-(2**63), 2**63)) for _ in range(200)]
    df = spark.createDataFrame(data, "s string, i int, l long")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for keys in (("s",), ("i",), ("l",), ("s", "i"), ("l", "s")):
        got = df.select(*keys, F.xxhash64(*keys).alias("h"), *(S.bucket_of(keys, f, b).alias(f"b{f}_{b}") for f, b in ((1, 1), (3, 7), (16, 40)))).collect()
        for r in got:
            h = key_hash(tuple(r[k] for k in keys), tuple(kinds[k] for k in keys))
            assert h == r.h % (1 << 64) and all(bucket_number(h, f, b) == r[f"b{f}_{b}"] for f, b in ((1, 1), (3, 7), (16, 40)))


def test_the_source_reads_what_the_table_holds(spark, tmp_path):
    state = State(spark, f"file://{tmp_path}/state", buckets=4, bucket_rows=120)
    assert load(spark, state, "silver_ig_posts").isEmpty()
    table = state.table("silver_ig_posts")
    for step, ids in enumerate((range(400), range(0, 400, 40), range(390, 420), range(5))):
        table.upsert(posts(spark, list(ids), f"step {step}"))
        assert sorted(map(tuple, load(spark, state, "silver_ig_posts").collect())) == sorted(map(tuple, table.read().collect()))
    assert any(len(r) > 1 for r in table.runs().values())
    letters = rows(spark, DEAD_LETTER, {"post_id": ["a", "a", "b"], "domain": ["x", "y", "x"], "error": ["e"] * 3})
    state.table("dead_letter").upsert(letters)
    assert load(spark, state, "dead_letter").where("post_id = 'a' AND domain = 'y'").count() == 1 and load(spark, state, "dead_letter").where("post_id = 'a'").count() == 2


def test_keys_are_looked_up_in_their_buckets(spark, tmp_path):
    state = State(spark, f"file://{tmp_path}/state", buckets=8)
    state.table("silver_ig_posts").upsert(posts(spark, list(range(300)), "x"))
    df = load(spark, state, "silver_ig_posts")
    assert df.rdd.getNumPartitions() == 8
    one = df.where(F.col("post_id") == "17")
    assert one.rdd.getNumPartitions() == 1 and [r.post_id for r in one.collect()] == ["17"]
    some = df.where(F.col("post_id").isin("17", "18", "999"))
    assert some.rdd.getNumPartitions() <= 3 and sorted(r.post_id for r in some.collect()) == ["17", "18"]
    assert df.where("caption = 'x' AND post_id = '3'").count() == 1 and df.where("post_id = 'none'").isEmpty()


def test_a_view_in_another_session_sees_later_commits(spark, tmp_path, request):
    state = State(spark, f"file://{tmp_path}/state", buckets=2)
    state.table("silver_ig_posts").upsert(posts(spark, [1, 2], "old"))
    create_catalog_view(state, "lake_")
    other = spark.newSession()
    spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(other._jsparkSession)  # else the first one's sources are taken
    other.dataSource.register(StateSource)
    other.conf.set(PUSHDOWN, "true")
    request.addfinalizer(lambda: spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession))
    assert sorted((r.post_id, r.caption, r.result_json) for r in other.table("lake_analytics_views").collect()) == [("1", "old", None), ("2", "old", None)]
    with state.transaction():
        state.table("silver_ig_posts").upsert(posts(spark, [2, 3], "new"))
        state.table("gold_ig_analyses").upsert(rows(spark, GOLD, {"post_id": ["3"], "result_json": ["{}"], "analysed_at": [T0]}))
        state.table("dim_profile").upsert(rows(spark, DIM_PROFILE, {"profile_key": [1, 2], "owner_id": ["o0", "o0"], "channel": ["c", "d"], "is_current": [False, True]}))
    got = other.table("lake_analytics_views")
    assert sorted((r.post_id, r.caption, r.result_json, r.profile_key) for r in got.collect()) == [("1", "old", None, None), ("2", "new", None, None), ("3", "new", "{}", 2)]
    plain = analytics_view(*(state.table(t).read() for t in ("silver_ig_posts", "gold_ig_analyses", "dim_profile")))
    assert got.columns == plain.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
