"""Delta runs, folding and growing buckets of state tables."""

import json
import random

from pyspark.sql import functions as F

from stratum.operators.dedup import diagonal_union, latest_per_key
from stratum.sources import state as S
from stratum.sources.state import StateTable

KV = "id long, name string, n int"


def table(spark, tmp_path, **options) -> StateTable:
    return StateTable(spark, f"file://{tmp_path}/t", spark.createDataFrame([], KV).schema, ("id",), **options)


def content(df) -> dict:
    rows = df.collect()
    assert len(rows) == len({r.id for r in rows})
    return {r.id: (r.name, r.n) for r in rows}


def size_of(tmp_path, version: int) -> int:
    return sum(p.stat().st_size for p in (tmp_path / "t").glob(f"_v={version}*/**/*.parquet"))


def test_what_an_increment_writes_grows_with_the_increment(spark, tmp_path):
    t = table(spark, tmp_path, buckets=32)
    text = F.concat_ws("", *(F.sha2(F.concat("id", F.lit(str(i))), 512) for i in range(8)))
    t.replace(spark.range(40_000).select("id", text.alias("name"), F.lit(0).alias("n")))
    t.upsert(spark.range(0, 40_000, 100).select("id", F.concat(text, F.lit("!")).alias("name"), F.lit(1).alias("n")))
    assert len(t.runs()) == 32 and all(len(r) <= 2 for r in t.runs().values())
    assert size_of(tmp_path, 2) < 0.03 * size_of(tmp_path, 1)  # 1 % of the rows, and a footer for each file
    assert t.read().count() == 40_000 and t.read().where("n = 1").count() == 400


def test_reads_equal_plain_upserts_through_folds_and_splits(spark, tmp_path):
    rng = random.Random(5)
    t, plain, folded, longest = table(spark, tmp_path, buckets=2, bucket_rows=60), {}, False, 0
    for step in range(12):
        rows = {i: (f"s{step}-{i}", rng.choice([None, step])) for i in rng.sample(range(500), rng.choice([3, 10, 60, 120]))}
        t.upsert(spark.createDataFrame([(i, *v) for i, v in rows.items()], KV))
        earlier, plain = plain, plain | rows
        assert content(t.read()) == plain
        folded |= any(r["folder"].endswith("f") for runs in t.runs().values() for r in runs)
        longest = max(longest, *(len(r) for r in t.runs().values()))
        if step == 6:
            t.delete_where("id < 50")
            plain = {i: v for i, v in plain.items() if i >= 50}
    assert folded and longest > 1 and len(t.runs()) > 4
    assert content(t.read(t.version() - 1)) == earlier  # the backup
    some = [(i,) for i in list(plain)[:5]] + [(10_000,)]
    assert content(t.lookup(*some)) == {i: v for i, v in plain.items() if (i,) in some}


def test_a_table_grows_bucket_by_bucket(spark, tmp_path):
    t, versions = table(spark, tmp_path, buckets=1, bucket_rows=25), []
    for step in range(8):
        t.upsert(spark.range(step * 200, step * 200 + 200).select("id", F.lit("x").alias("name"), F.lit(step).alias("n")))
        versions.append(t._manifest(t.version())["buckets"])
    assert versions == [8 * (i + 1) for i in range(8)] and versions[-1] == 64
    assert content(t.read()) == {i: ("x", i // 200) for i in range(1600)}
    # From 56 to 64 buckets, those from 24 to 31 were split; the others have runs of before.
    assert S.split_buckets(1, 56, 64) == set(range(24, 32))
    untouched = [b for b, runs in t.runs().items() if b < 24 and not runs[0]["folder"].startswith("8")]
    assert untouched


def test_linear_hashing_moves_rows_of_split_buckets_only(spark):
    ids = spark.range(2000)
    for first, old, new in ((1, 1, 2), (1, 3, 4), (2, 5, 11), (3, 3, 20)):
        rows = ids.select("id", S.bucket_of(("id",), first, old).alias("a"), S.bucket_of(("id",), first, new).alias("b")).collect()
        assert {r.a for r in rows} == set(range(old)) and {r.b for r in rows} == set(range(new))
        assert {r.a for r in rows if r.a != r.b} == S.split_buckets(first, old, new)


def test_when_runs_are_folded():
    assert S.first_to_fold([1000]) is None and S.first_to_fold([1000, 10]) is None
    assert S.first_to_fold([1000, 300, 200]) == 0
    assert S.first_to_fold([100_000, 10, 12, 9]) is None and S.first_to_fold([100_000, 10, 12, 9, 8]) == 1
    assert S.first_to_fold([100_000, 3000, 10, 12, 9, 8]) == 2
    # Each row is rewritten some log times, whatever the number of increments.
    runs, written = [10_000_000], 0
    for _ in range(4000):
        runs.append(10)
        written += 10
        start = S.first_to_fold(runs)
        if start is not None:
            total = sum(runs[start:])
            written += total
            runs[start:] = [total]
    assert written < 10 * 4000 * 8 and len(runs) < 4 * 8


def test_a_merge_reads_runs_that_can_hold_its_keys_and_writes_changed_rows(spark, tmp_path):
    t = table(spark, tmp_path)
    t.replace(spark.createDataFrame([(i, "old", i) for i in range(100)], KV))
    t.upsert(spark.createDataFrame([(1000 + i, "high", i) for i in range(30)], KV))
    seen = {}

    def newest(old, new):
        seen["old"] = content(old)
        return latest_per_key(diagonal_union([old, new]), ["id"], [F.desc("n")])

    t.merge(spark.createDataFrame([(5, "lower", 1), (6, "higher", 99), (6, "lowest", 0), (1001, "higher", 99), (2000, "new", 0)], KV), newest)
    assert seen["old"] == {5: ("old", 5), 6: ("old", 6), 1001: ("high", 1)}
    got = content(t.read())
    assert got[5] == ("old", 5) and got[6] == ("higher", 99) and got[1001] == ("higher", 99) and got[2000] == ("new", 0) and len(got) == 131
    assert t.runs()[0][-1]["rows"] == 3  # the row that stayed wasn't written
    read = []
    before = t._load
    t._load = lambda folders, schema=None: (read.append(folders), before(folders, schema))[1]
    t.merge(spark.createDataFrame([(9000, "far", 0)], KV), newest)
    assert seen["old"] == {} and all("_staging" in f or "_v=4" in f for folders in read for f in folders)


def test_manifests_without_runs_are_read(spark, tmp_path):
    t = table(spark, tmp_path, buckets=2)
    t.replace(spark.createDataFrame([(i, "a", i) for i in range(20)], KV))
    path = tmp_path / "t/_manifest-1"
    path.write_text(json.dumps({"buckets": 2, "folders": {str(b): 1 for b in t.runs()}}))
    (tmp_path / "t/._manifest-1.crc").unlink(missing_ok=True)
    assert t.read().count() == 20
    t.upsert(spark.createDataFrame([(3, "b", 0)], KV))
    assert content(t.read())[3] == ("b", 0) and t.read().count() == 20


def test_bases_are_read_without_a_shuffle(spark, tmp_path):
    t = table(spark, tmp_path, buckets=2)
    t.replace(spark.createDataFrame([(i, "a", i) for i in range(200)], KV))
    t.upsert(spark.createDataFrame([(1, "b", 1), (2, "b", 1)], KV))
    plan = t.read()._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "strategy=broadcast" in plan
