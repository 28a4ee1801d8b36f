import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratum.llm.queries import op1_sharding
from stratum.llm.sharding import CommitConflict, Run, ShardStore
from stratum.llm.support import file_system

from .common import documents, edge_cases, prose


@pytest.fixture
def store(spark, tmp_path):
    schema = documents(spark, [], clashes=False).schema
    return ShardStore(spark, f"file://{tmp_path}/store", schema, target_bytes=60_000)


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_everything_is_read_back_once(spark, store):
    docs = documents(spark, edge_cases())
    store.append_each(docs, F.col("doc_id") % 3)
    store.append(docs.where("doc_id > 4"))
    want = rows(docs.select(*store.schema.names).union(docs.where("doc_id > 4").select(*store.schema.names)))
    assert rows(store.read()) == want
    store.compact()
    store.vacuum()
    assert rows(store.read()) == want


def test_tiers_merge_into_target_sized_shards(spark, store):
    rng = random.Random(1)
    for i in range(9):
        store.append(documents(spark, [(100 * i + j, prose(rng, 200)) for j in range(40)]))
    before = store.manifest()
    assert len(before.runs) == 9 and {r.tier for r in before.runs} == {0}
    after = store.compact()
    assert len(after.runs) < 4 and sum(r.rows for r in after.runs) == 360
    big = max(after.runs, key=lambda r: r.bytes)
    assert big.files < 9 * 3 and big.bytes / big.files > 15_000
    assert rows(store.read(before.version)) == rows(store.read())  # an old version stays readable
    store.vacuum()
    assert store.versions() == [after.version]


def test_a_bulk_arrival_is_merged_alone_to_shards_near_the_target(spark, store):
    rng = random.Random(2)
    docs = documents(spark, [(i, prose(rng, 200)) for i in range(800)]).repartition(40)
    store.append(docs)
    (before,) = store.manifest().runs
    assert before.files == 40 and before.bytes / before.files < store.target_bytes / 4
    (after,) = store.compact().runs
    sizes = [s.getLen() for s in files_of(spark, after)]
    assert len(sizes) == after.files > 1 and all(store.target_bytes / 2 < b < 2 * store.target_bytes for b in sizes)
    assert rows(store.read(1)) == rows(store.read())
    assert store.compact() == store.manifest() and store.manifest().runs == (after,)  # it isn't due again


def test_runs_of_target_sized_shards_move_by_their_entry(spark, store):
    rng = random.Random(5)
    for i in range(4):
        store.append(documents(spark, [(1000 * i + j, prose(rng, 200)) for j in range(100)]).coalesce(1))
    before = store.manifest().runs
    assert len({r.tier for r in before}) == 1 and all(r.full(store.target_bytes) for r in before)
    (after,) = store.compact().runs
    assert set(after.paths) == {p for r in before for p in r.paths} and after.rows == 400
    store.vacuum()
    assert store.read().count() == 400


def test_object_stores_are_refused(spark, store):
    with pytest.raises(ValueError, match="atomic"):
        ShardStore(spark, "s3a://bucket/store", store.schema)


def test_columns_named_like_internal_ones(spark, tmp_path):
    df = spark.createDataFrame([(1, 2), (None, 3)], "__run long, path long")
    store = ShardStore(spark, f"file://{tmp_path}/odd", df.schema)
    store.append_each(df, F.col("path"))
    assert rows(store.read()) == rows(df)


def files_of(spark, run):
    fs, folder = file_system(spark, run.paths[0])
    return [s for s in fs.listStatus(folder) if s.getPath().getName().endswith(".parquet")]


def test_the_registered_query_merges_every_row(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    documents(spark, [(i, prose(rng, 30)) for i in range(400)]).write.parquet(f"{tmp_path}/documents.parquet")
    appended, compacted = set(), []
    append_each, compact = ShardStore.append_each, ShardStore.compact

    def appending(self, *args):
        manifest = append_each(self, *args)
        appended.update(p for r in manifest.runs for p in r.paths)
        return manifest

    def compacting(self):
        compacted.append(compact(self))
        return compacted[0]

    monkeypatch.setattr(ShardStore, "append_each", appending)
    monkeypatch.setattr(ShardStore, "compact", compacting)
    assert op1_sharding(spark, str(tmp_path)).count() == 400
    (manifest,) = compacted
    assert len(appended) == 36 and not appended & {p for r in manifest.runs for p in r.paths}
    assert sum(r.rows for r in manifest.runs) == 400 and sum(r.files for r in manifest.runs) < 4


def test_one_of_two_writers_commits(spark, store):
    base = store.manifest()
    run = Run(("x",), 1, 1, 1)
    store.commit(base, (run,))
    with pytest.raises(CommitConflict):
        store.commit(base, ())
    assert store.manifest().runs == (run,)


def test_empty_arrivals_and_missing_columns(spark, store):
    store.append(documents(spark, []))
    store.append_each(documents(spark, []), F.col("doc_id"))
    assert store.read().isEmpty() and store.manifest().runs == ()
    store.append(spark.createDataFrame([("t", 1)], "text string, other int"))
    assert tuple(store.read().first()) == (None, "t", None, None, None)


def test_tiers():
    assert [Run(("",), 1, b, 1).tier for b in (0, 1 << 20, (1 << 20) + 1, 5 << 20, 17 << 20)] == [0, 0, 1, 2, 3]
