"""The catalog of bronze files, datasets that are kept back, and counts after streams and migrations."""

import datetime as dt
import shutil
import time

from pyspark.sql import functions as F

from stratum.plans.pipeline import Pipeline
from stratum.plans.silver import run_silver
from stratum.schemas import BRONZE, SILVER
from stratum.sources import bronze as B
from stratum.sources.catalog import CATALOG, QUARANTINE, bronze_rows, refresh
from stratum.streaming.bronze import LEDGER, merge_batch, stream_bronze

from .helpers import T0, bronze, by_id, lake_and_state, post


def folder_of(spark, lake, name, rows, parts):
    """A dataset of several part files."""
    df = spark.createDataFrame([tuple(r.get(n) for n in BRONZE.names) for r in rows], BRONZE).repartition(parts)
    df.write.mode("overwrite").parquet(f"{lake.bronze}/{name}.parquet")


def parts_of(tmp_path, name):
    return sorted((tmp_path / f"lake/bronze/{name}.parquet").glob("part-*.parquet"))


def later(days: int) -> dt.datetime:
    return T0 + dt.timedelta(days=days)


def test_a_dataset_with_a_cut_part_is_kept_back_until_it_is_whole(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    folder_of(spark, lake, "good", [post(f"g{i}") for i in range(20)], 2)
    folder_of(spark, lake, "cut", [post(f"c{i}", caption="x" * 50) for i in range(400)], 4)
    part = parts_of(tmp_path, "cut")[1]
    whole = part.read_bytes()
    part.write_bytes(whole[: len(whole) // 2])
    assert {i[0] for i in by_id(run_silver(lake, state, T0))} == {"g"}
    (row,) = state.table(QUARANTINE).read().collect()
    assert row.dataset_id == "cut" and part.name in row.reason and row.first_seen == T0
    assert by_id(state.table("silver_ig_progress").read(), "source_dataset")["cut"].post_count == 0
    run_silver(lake, state, later(1))
    (row,) = state.table(QUARANTINE).read().collect()
    assert (row.first_seen, row.last_seen) == (T0, later(1))
    old = time.time() - 3600  # repaired with an old time: the mark has passed it
    part.write_bytes(whole)
    part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
    import os

    os.utime(part, (old, old))
    assert len(by_id(run_silver(lake, state, later(2)))) == 420 and state.table(QUARANTINE).read().isEmpty()
    assert by_id(state.table("silver_ig_progress").read(), "source_dataset")["cut"].post_count == 400


def test_a_dataset_with_damaged_pages_is_kept_back(spark, tmp_path):
    """The footer is whole, and a scan that skips what it can't read gives some rows."""
    lake, state = lake_and_state(spark, tmp_path)
    folder_of(spark, lake, "good", [post("g")], 1)
    folder_of(spark, lake, "bad", [post(f"b{i}", caption=str(i) * 9) for i in range(300)], 3)
    part = parts_of(tmp_path, "bad")[0]
    raw = bytearray(part.read_bytes())
    for i in range(4, len(raw) // 3):
        raw[i] ^= 0x5A
    part.write_bytes(raw)
    part.with_name(f".{part.name}.crc").unlink()
    assert set(by_id(run_silver(lake, state, T0))) == {"g"}
    (row,) = state.table(QUARANTINE).read().collect()
    assert row.dataset_id == "bad" and row.n_expected == 300 and row.n_found < 300


def test_known_files_are_not_opened_again(spark, tmp_path, monkeypatch):
    lake, state = lake_and_state(spark, tmp_path)
    for i in range(30):
        bronze(spark, lake, f"ds_{i:03}", [post(str(i))])
    opened = []
    from stratum.sources import catalog

    monkeypatch.setattr(catalog, "footers", lambda files: (opened.append(files.count()), B.footers(files))[1])
    assert bronze_rows(refresh(state, lake.bronze)) == 30 and opened == [30]
    refresh(state, lake.bronze)
    assert opened == [30]
    bronze(spark, lake, "ds_003", [post("3"), post("x")])
    shutil.rmtree(tmp_path / "lake/bronze/ds_004.parquet")
    (tmp_path / "lake/bronze/deeper/er").mkdir(parents=True)
    shutil.copytree(tmp_path / "lake/bronze/ds_005.parquet", tmp_path / "lake/bronze/deeper/er/no.parquet")
    found = refresh(state, lake.bronze)
    assert opened == [30, 1] and bronze_rows(found) == 30 and found.select("dataset_id").distinct().count() == 29


def test_one_schema_is_inferred_once_and_parts_may_differ(spark, tmp_path):
    import pyarrow as pa
    from pyarrow import parquet

    lake, state = lake_and_state(spark, tmp_path)
    folder = tmp_path / "lake/bronze"
    (folder / "mixed.parquet").mkdir(parents=True)
    for i in range(6):
        parquet.write_table(pa.table({"id": [f"p{i}"], "caption": ["c"]}), folder / f"other_{i}.parquet")
    parquet.write_table(pa.table({"id": ["m1"], "likesCount": [3]}), folder / "mixed.parquet/part-0.parquet")
    parquet.write_table(pa.table({"id": [7], "likesCount": ["5"], "more": [True]}), folder / "mixed.parquet/part-1.parquet")
    parquet.write_table(pa.table({"x": [1]}), folder / "idless.parquet")
    rows = by_id(run_silver(lake, state, T0))
    assert set(rows) == {*(f"p{i}" for i in range(6)), "m1", "7"} and rows["7"].likes_count == 5 and rows["7"].source_dataset == "mixed"
    assert state.table(CATALOG).read().select("fingerprint").distinct().count() == 4
    assert by_id(state.table("silver_ig_progress").read(), "source_dataset")["idless"].post_count == 0


def bounded(pipeline) -> dict:
    return next(dict(r.metadata) | {"passed": r.passed} for r in pipeline.silver_checks() if r.name == "ig_posts_slv_row_count_bounded")


def test_row_bound_after_batch_stream_migration_and_removal(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    pipeline = Pipeline(spark, lake)
    bronze(spark, lake, "ds_1", [post(f"a{i}") for i in range(40)])
    run_silver(lake, state, T0)
    time.sleep(0.01)
    bronze(spark, lake, "ds_2", [post(f"b{i}") for i in range(30)])
    stream_bronze(state, lake.bronze, f"file://{tmp_path}/cp").awaitTermination()
    assert bounded(pipeline) == {"n_part": 70, "n_whole": 70, "bounded": True, "passed": True}
    assert {r.source_dataset: r.post_count for r in state.table("silver_ig_progress").read().collect()} == {"ds_1": 40, "ds_2": 30}
    state.table("silver_ig_posts").upsert(spark.createDataFrame([("migrated",)], "post_id string").select("post_id", *(F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER.fields[1:])))
    assert not bounded(pipeline)["passed"]  # a post more than there are bronze rows
    shutil.rmtree(tmp_path / "lake/bronze/ds_1.parquet")
    assert bounded(pipeline)["n_whole"] == 30
    other = lake_and_state(spark, tmp_path / "other")
    assert bounded(Pipeline(spark, other[0])) == {"n_part": 0, "n_whole": 0, "bounded": True, "passed": True}


def test_a_batch_that_is_replayed_changes_nothing(spark, tmp_path, monkeypatch):
    lake, state = lake_and_state(spark, tmp_path)
    rows = spark.createDataFrame([tuple(post("1").get(n) for n in BRONZE.names), tuple(post("2").get(n) for n in BRONZE.names)], BRONZE).withColumn("source_dataset", F.lit("ds"))
    from stratum.streaming import bronze as stream

    real = stream.record_progress
    monkeypatch.setattr(stream, "record_progress", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    try:
        merge_batch(state, rows, "s", 0, T0)
    except RuntimeError:
        pass
    monkeypatch.setattr(stream, "record_progress", real)
    merge_batch(state, rows, "s", 0, later(5))  # replayed later, with the timestamp of its first try
    assert {r.processed_on for r in state.table("silver_ig_posts").read().collect()} == {T0}
    version = state.table("silver_ig_posts").version()
    merge_batch(state, rows, "s", 0, later(6))
    assert state.table("silver_ig_posts").version() == version
    (row,) = state.table(LEDGER).read().collect()
    assert tuple(row) == ("s", 0, T0, 2, True) and state.table("silver_ig_progress").read().first().completed_at == T0
    merge_batch(state, rows, "s", 1, later(7))
    assert state.table(LEDGER).read().count() == 2
