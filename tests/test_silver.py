import datetime as dt
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.dedup import diagonal_union, latest_posts
from stratum.operators.normalize import add_defaults, normalize, rename_columns
from stratum.operators.upsert import progress
from stratum.plans.silver import run_silver
from stratum.schemas import SILVER

from .helpers import T0, bronze, by_id, lake_and_state, post

LATER = "2024-06-01T00:00:00.000Z"


@pytest.mark.parametrize(
    "rows, ids",
    [
        ([post("1")], {"1"}),
        ([post("1"), post("1", timestamp=LATER)], {"1"}),
        ([post("1", timestamp=None), post("1")], {"1"}),
        ([post("1")] * 3, {"1"}),
        ([post(None), post("1")], {"1"}),
    ],
)
def test_dedup_in_a_dataset(spark, tmp_path, rows, ids):
    lake, state = lake_and_state(spark, tmp_path)
    bronze(spark, lake, "ds_001", rows)
    assert set(by_id(run_silver(lake, state, T0))) == ids


def test_latest_wins_across_datasets_then_dataset_name(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    bronze(spark, lake, "ds_001", [post("1", "old"), post("2", "a"), post("3", "only")])
    bronze(spark, lake, "ds_002", [post("1", "New caption", LATER), post("2", "b")])
    rows = by_id(run_silver(lake, state, T0))
    assert (rows["1"].caption, rows["1"].source_dataset) == ("New caption", "ds_002")
    assert rows["2"].caption == "b" and rows["3"].source_dataset == "ds_001"
    done = by_id(state.table("silver_ig_progress").read(), "source_dataset")
    assert {k: v.post_count for k, v in done.items()} == {"ds_001": 1, "ds_002": 2}


def test_columns_are_normalised(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    bronze(spark, lake, "ds", [post("1", hashtags=["a"], url=None), post("2", url="https://x/2", timestamp="garbage")])
    rows = by_id(run_silver(lake, state, T0))
    assert rows["1"].url == "https://instagram.com/p/sc1/" and rows["2"].url == "https://x/2"
    assert rows["1"].hashtags == '["a"]' and rows["2"].hashtags == "[]" and rows["2"].timestamp is None
    assert rows["1"].timestamp == dt.datetime(2024, 1, 1) and rows["1"].processed_on == T0
    assert rows["1"].media_files == "[]" and rows["1"].media_count == 0 and rows["1"].has_engagement_bait is False


def test_drifting_types_extra_and_missing_columns(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    narrow = T.StructType([T.StructField("id", T.LongType()), T.StructField("caption", T.StringType()), T.StructField("likesCount", T.StringType()), T.StructField("surprise", T.ArrayType(T.LongType()))])
    bronze(spark, lake, "a", [{"id": 1, "caption": "x", "likesCount": "many", "surprise": [1]}, {"id": 2, "caption": "y", "likesCount": "7", "surprise": None}], narrow)
    bronze(spark, lake, "b", [post("3")])
    rows = by_id(run_silver(lake, state, T0))
    assert set(rows) == {"1", "2", "3"} and rows["1"].likes_count is None and rows["2"].likes_count == 7
    assert rows["1"].timestamp is None and rows["1"].url is None and rows["1"].__fields__ == SILVER.names


def test_corrupt_and_idless_datasets_are_skipped(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    bronze(spark, lake, "good", [post("1")])
    bronze(spark, lake, "noid", [{"x": "1"}], T.StructType([T.StructField("x", T.StringType())]))
    (tmp_path / "lake/bronze/bad.parquet").write_bytes(b"this is not parquet")
    assert set(by_id(run_silver(lake, state, T0))) == {"1"}
    assert {r.source_dataset: r.post_count for r in state.table("silver_ig_progress").read().collect()} == {"bad": 0, "good": 1, "noid": 0}


def test_empty_lake_and_empty_dataset(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    assert run_silver(lake, state, T0).schema == SILVER and run_silver(lake, state, T0).isEmpty()
    bronze(spark, lake, "empty", [])
    assert run_silver(lake, state, T0).isEmpty()


def test_second_run_reads_new_datasets_only_and_keeps_stamps(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    bronze(spark, lake, "ds_001", [post("1"), post("2")])
    run_silver(lake, state, T0)
    version = state.table("silver_ig_posts").version()
    run_silver(lake, state, T0 + dt.timedelta(days=1))
    assert state.table("silver_ig_posts").version() == version
    time.sleep(1.1)
    bronze(spark, lake, "ds_002", [post("2", "again", LATER), post("3")])
    rows = by_id(run_silver(lake, state, T0 + dt.timedelta(days=2)))
    assert rows["1"].processed_on == T0 and rows["2"].processed_on == rows["3"].processed_on == T0 + dt.timedelta(days=2)


def test_partitioned_dataset_folders_are_read(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    bronze(spark, lake, "x", [post("1")])
    (tmp_path / "lake/bronze/x.parquet").rename(tmp_path / "lake/bronze/dataset_id=ds_9")
    assert by_id(run_silver(lake, state, T0))["1"].source_dataset == "ds_9"


def test_rename_keeps_taken_names_and_defaults_fill_gaps(spark):
    df = rename_columns(spark.createDataFrame([("a", "b")], "id string, post_id string"))
    assert df.columns == ["id", "post_id"]
    assert add_defaults(df).first().media_count == 0


def test_union_casts_to_the_schema(spark):
    a, b = spark.createDataFrame([(1,)], "post_id int"), spark.createDataFrame([("x", "2024-01-01T00:00:00Z")], "post_id string, timestamp string")
    assert {(r.post_id, r.timestamp) for r in diagonal_union([a, b], SILVER).collect()} == {("1", None), ("x", dt.datetime(2024, 1, 1))}


def test_existing_row_wins_an_exact_tie(spark):
    rows = normalize(spark.createDataFrame([("1", "2024-01-01T00:00:00Z")], "id string, timestamp string"), F.lit("ds"))
    old = rows.withColumn("processed_on", F.lit("2020-01-01").cast("timestamp_ntz"))
    assert latest_posts(diagonal_union([rows, old])).first().processed_on == dt.datetime(2020, 1, 1)


def test_dedup_matches_a_dictionary(spark):
    rows = [(str(i % 7), i % 3, f"d{i % 4}", i) for i in range(200)]
    best: dict = {}
    for key, ts, ds, i in rows:
        if key not in best or (ts, ds, -i) > best[key][0]:
            best[key] = ((ts, ds, -i), i)
    from stratum.operators.dedup import latest_per_key

    df = spark.createDataFrame(rows, "k string, ts int, ds string, i int")
    got = latest_per_key(df, ["k"], [F.desc_nulls_last("ts"), F.desc_nulls_last("ds"), F.asc("i")])
    assert {r.k: r.i for r in got.collect()} == {k: v[1] for k, v in best.items()}


def test_progress_counts_datasets_without_wins(spark):
    won = spark.createDataFrame([("a",), ("a",)], "source_dataset string")
    seen = spark.createDataFrame([("a",), ("b",)], "source_dataset string")
    assert {(r.source_dataset, r.post_count) for r in progress(won, seen).collect()} == {("a", 2), ("b", 0)}
