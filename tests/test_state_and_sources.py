import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stratum.config import Lake, ScrapeConfig
from stratum.operators import checks
from stratum.operators.upsert import upsert
from stratum.plans.migrate import import_ndjson, migrate, run_import
from stratum.plans.pipeline import Pipeline
from stratum.schemas import BRONZE
from stratum.sources.ndjson import scan_ndjson
from stratum.sources.scrape import Run, ingest, read_meta
from stratum.sources.state import KeyViolation, Locked, NoTable, State, StateTable
from stratum.streaming.bronze import stream_bronze

from .helpers import T0, Fake, bronze, by_id, lake_and_state, post


def test_state_versions_upsert_and_delete(spark, tmp_path):
    _, state = lake_and_state(spark, tmp_path)
    table = state.table("silver_ig_progress")
    assert table.read().isEmpty() and table.version() == 0
    row = lambda *r: spark.createDataFrame(r, "post_count int, source_dataset string")  # noqa: E731  another order: bound by name
    table.upsert(row((1, "a"), (2, "b")))
    table.upsert(row((5, "b")))
    assert {(r.source_dataset, r.post_count) for r in table.read().collect()} == {("a", 1), ("b", 5)}
    assert {r.post_count for r in table.read(1).collect()} == {1, 2}  # the version before is a backup
    table.delete_where("source_dataset = 'a'")
    assert table.read().count() == 1 and table.version() == 3
    with pytest.raises(KeyViolation):
        table.upsert(row((1, "x"), (2, "x")))
    with pytest.raises(KeyViolation):
        table.upsert(row((1, None)))
    with table.lock(), pytest.raises(Locked):
        table.upsert(row((1, "x")))
    assert state.names() == ["silver_ig_progress"]


def test_upsert_binds_by_name(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([("z", 2), ("w", 3)], "v string, k int")
    assert {(r.k, r.v) for r in upsert(a, b, ["k"]).collect()} == {(1, "x"), (2, "z"), (3, "w")}


class Service:
    def __init__(self, lines, fail=None):
        self.lines, self.fail, self.downloads = lines, fail, 0

    def trigger(self, config, token):
        return Run("run-1", "actor-1")

    def wait(self, run, token):
        if self.fail:
            raise RuntimeError(self.fail)
        return "ds_001"

    def download(self, dataset_id, dest, token):
        self.downloads += 1
        path = dest.removeprefix("file://")
        with open(path, "w") as f:
            f.writelines(json.dumps(x) + "\n" for x in self.lines)
        return len(self.lines)


def test_ingest(spark, tmp_path):
    (tmp_path / "b").mkdir()
    folder = f"file://{tmp_path}/b"
    service = Service([{"id": "1", "likesCount": 10}, {"id": "2", "likesCount": 20}])
    df = ingest(spark, service, ScrapeConfig(["u"]), folder, "token", dt.datetime(2024, 1, 1))
    assert df.count() == 2 and read_meta(spark, f"{folder}/ds_001.parquet") == {"run_id": "run-1", "actor": "actor-1", "item_count": 2, "downloaded_at": "2024-01-01T00:00:00"}
    assert not list((tmp_path / "b").glob("*.jsonl"))
    ingest(spark, service, ScrapeConfig(["u"]), folder, "token")
    assert service.downloads == 1
    with pytest.raises(RuntimeError, match="token"):
        ingest(spark, service, ScrapeConfig(["u"]), folder, "")
    for reason in ("failed", "timed out"):
        with pytest.raises(RuntimeError, match=reason):
            ingest(spark, Service([], reason), ScrapeConfig(["u"]), folder, "token")


def test_ingest_of_nothing_has_the_bronze_columns(spark, tmp_path):
    (tmp_path / "b").mkdir()
    df = ingest(spark, Service([]), ScrapeConfig(["u"]), f"file://{tmp_path}/b", "token")
    assert df.columns == BRONZE.names and df.isEmpty()


def test_ndjson_with_a_bad_line(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id":"1"}\nnot json\n')
    assert {r.id for r in scan_ndjson(spark, str(tmp_path / "x.jsonl"), BRONZE).collect()} == {"1", None}


def test_config_from_env():
    lake = Lake.from_env({"IG_DATA_DIR": "/d", "IG_GOLD_DIR": "/g"})
    assert (lake.bronze, lake.gold, lake.state) == ("/d/lake/bronze", "/g", "/d/state")


def test_import_and_migration(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    raw, silver, gold = tmp_path / "raw", tmp_path / "old_silver", tmp_path / "old_gold"
    for folder in (raw, silver / "p1", gold):
        folder.mkdir(parents=True)
    rows = [("1", "abc", "user1", 10), ("2", "def", "user2", 20), ("3", "ghi", "user3", 30)]
    (raw / "ds_001.jsonl").write_text("".join(json.dumps({"id": i, "shortCode": s, "ownerUsername": u, "likesCount": n}) + "\n" for i, s, u, n in rows))
    (raw / "ds_001.meta").write_text("{}")
    (raw / "bad.jsonl").write_text('{"id":"1"}\nthis is not valid json\n{"id":"2"}\n')
    (raw / "empty.jsonl").write_text("")
    (silver / "p1/post.json").write_text(json.dumps({"id": "p1", "caption": "c", "hashtags": ["x"], "timestamp": "2024-01-01T00:00:00Z", "likesCount": 5}, indent=1))
    (gold / "p1.json").write_text(json.dumps({"schema_version": 2, "result_json": {"a": 1}, "analysed_at": "2024-02-01T00:00:00"}, indent=1))
    (gold / "p2.json").write_text(json.dumps({"post_id": "p2", "status": "failed", "error": "e", "attempts": 3}))
    (gold / "p3.json").write_text("{ malformed")
    paths = (f"file://{raw}", lake.bronze, f"file://{silver}", f"file://{gold}")
    assert run_import(state, *paths, T0) == {"phase1": 1, "phase2": (1, 2)}
    assert run_import(state, *paths, T0) == {}
    assert spark.read.parquet(f"{lake.bronze}/ds_001.parquet").count() == 3 and (tmp_path / "lake/bronze/ds_001.parquet.meta").exists()
    migrate(state, T0)
    posts = by_id(state.table("silver_ig_posts").read())
    assert posts["p1"].hashtags == '["x"]' and posts["p1"].processed_on == T0 and posts["p1"].likes_count == 5
    analyses = by_id(state.table("gold_ig_analyses").read())
    assert set(analyses) == {"p1"} and json.loads(analyses["p1"].result_json) == {"a": 1}
    assert by_id(state.table("dead_letter").read())["p2"].attempts == 3
    assert not state.exists("silver_posts") and state.mark("silver_ig") == T0 and state.mark("gold_ig") == dt.datetime(2024, 2, 1)
    migrate(state, T0)
    assert state.table("silver_ig_posts").read().count() == 1


SNAPSHOT = [
    ("post_001", "abc", "Great post about AI marketing", "owner_1", "user1", 120, 15),
    ("post_002", "def", "", "owner_1", "user1", 45, 3),
    ("post_003", "ghi", "Interesting take on startups", "owner_2", "user2", 300, 42),
    ("post_004", "jkl", "AI tools for productivity", "owner_3", "user3", 89, 7),
    ("post_005", "mno", "Marketing tips 2024", "owner_2", "user2", 210, 28),
]


def test_snapshot_end_to_end_and_rebuild(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    bronze(spark, lake, "bronze_sample", [post(i, c, owner=o, user=u, shortCode=s, likesCount=n, commentsCount=m) for i, s, c, o, u, n, m in SNAPSHOT])
    pipeline = Pipeline(spark, lake, Fake)
    results = pipeline.run(T0)
    failed = [r.name for r in results if not r.passed]
    assert failed == ["ig_posts_raw_has_meta"]
    got = {(r.post_id, r.shortcode, r.caption, r.owner_id, r.owner_username, r.likes_count, r.comments_count) for r in state.table("silver_ig_posts").read().collect()}
    assert got == set(SNAPSHOT)
    assert set(by_id(state.table("gold_ig_analyses").read())) == {"post_001", "post_003", "post_004", "post_005"}
    assert by_id(state.table("dead_letter").read())["post_002"].error == "Empty caption"
    assert state.table("dim_profile").read().where("is_current").count() == 3 and spark.table("analytics_views").count() == 5
    assert pipeline.contract().passed
    counts = pipeline.rebuild(T0)
    assert counts.pop("dim_time") == ((T0.date() + dt.timedelta(days=365)) - dt.date(2020, 1, 1)).days + 1
    assert counts == {"dead_letter": 1, "dim_profile": 3, "gold_ig_analyses": 4, "silver_ig_posts": 5, "silver_ig_progress": 1, "watermarks": 2}


def test_stream_merges_new_files_once(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    bronze(spark, lake, "ds_1", [post("1", "a"), post("2", "b")])
    for _ in range(2):
        stream_bronze(state, lake.bronze, f"file://{tmp_path}/cp").awaitTermination()
    assert state.table("silver_ig_posts").version() == 1
    bronze(spark, lake, "ds_2", [post("2", "new", "2024-06-01T00:00:00Z"), post("3")])
    stream_bronze(state, lake.bronze, f"file://{tmp_path}/cp").awaitTermination()
    rows = by_id(state.table("silver_ig_posts").read())
    assert set(rows) == {"1", "2", "3"} and rows["2"].caption == "new" and rows["2"].source_dataset == "ds_2"


def test_nothing_but_llm_imports_llm():
    from pathlib import Path

    root = Path(__file__).parent.parent / "stratum"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "llm" not in path.read_text(), path


def test_library_shipped_to_executors(spark):
    from stratum.session import ship

    ship(spark)
    ship(spark)
    assert spark.range(1).select(F.lit(1)).count() == 1


def test_datasets_are_read_by_tasks(spark):
    from stratum.sources.remote import DatasetFeed

    spark.dataSource.register(DatasetFeed)
    reader = spark.read.format("dataset_feed").schema("id string, likesCount long, hashtags array<string>, nested string").option("fetch", "tests.helpers:fetch_dataset")
    df = reader.option("ids", "ds_1,ds_2").load()
    assert df.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, df.collect()), key=str)[:2] == [("ds_1-0", None, ["a"], '{"x": 1}'), ("ds_1-1", 1, ["a"], '{"x": 1}')]
    assert reader.option("ids", "").load().isEmpty()


def test_a_scrape_downloads_by_tasks(spark, tmp_path):
    from stratum.sources.remote import FeedDownload

    class Service:
        def trigger(self, config, token):
            return Run("r", "a")

        def wait(self, run, token):
            return "ds_9"

    source = FeedDownload(spark, Service(), "tests.helpers:fetch_dataset")
    df = ingest(spark, source, ScrapeConfig(["u"]), f"file://{tmp_path}/bronze", "token")
    assert sorted(r.id for r in df.collect()) == ["ds_9-0", "ds_9-1"] and read_meta(spark, f"file://{tmp_path}/bronze/ds_9.parquet")["item_count"] == 2


def test_command_line(spark, tmp_path, capsys):
    from stratum.__main__ import main

    lake, state = lake_and_state(spark, tmp_path)
    bronze(spark, lake, "ds", [post("1"), post("2")])
    assert main(["run", f"file://{tmp_path}", "--analyzer", "tests.helpers:Fake"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert {"check": "ig_posts_slv_no_duplicates", "passed": True, "severity": "WARN", "total": 2, "distinct_keys": 2} in lines
    assert state.table("gold_ig_analyses").read().count() == 2
    assert main(["rebuild", f"file://{tmp_path}"]) == 0 and json.loads(capsys.readouterr().out)["silver_ig_posts"] == 2
    assert main(["contract", f"file://{tmp_path}"]) == 0 and json.loads(capsys.readouterr().out)["passed"]


def test_an_increment_rewrites_touched_buckets_only(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, name string").schema
    table = StateTable(spark, f"file://{tmp_path}/t", schema, ("id",), buckets=8)
    table.replace(spark.range(200).select("id", F.lit("old").alias("name")))
    before = {b: [r["folder"] for r in runs] for b, runs in table.runs(1).items()}
    assert len(before) == 8 and set(map(tuple, before.values())) == {("1",)}
    evaluated = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            evaluated.add(len(batch))
            yield batch

    table.upsert(spark.createDataFrame([(3, "new"), (1000, "new")], schema).mapInPandas(seen, schema))
    after = {b: [r["folder"] for r in runs] for b, runs in table.runs(2).items()}
    assert 1 <= sum(v == ["1", "2"] for v in after.values()) <= 2 and sum(v == ["1"] for v in after.values()) >= 6 and evaluated.value == 2
    assert {(r.id, r.name) for r in table.read().where("name = 'new'").collect()} == {(3, "new"), (1000, "new")} and table.read().count() == 201
    assert table.read(1).count() == 200  # the backup
    table.delete_where("id = 3")
    assert table.read().count() == 200 and table.version() == 3


def test_a_broken_key_leaves_the_table_as_it_is(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, name string").schema
    table = StateTable(spark, f"file://{tmp_path}/t", schema, ("id",), buckets=2)
    with pytest.raises(NoTable):
        table.read(required=True)
    table.replace(spark.createDataFrame([(1, "a")], schema))
    for rows in ([(2, "b"), (2, "c")], [(None, "d")]):
        with pytest.raises(KeyViolation):
            table.upsert(spark.createDataFrame(rows, schema))
        with pytest.raises(KeyViolation):
            table.replace(spark.createDataFrame(rows, schema))
    assert [tuple(r) for r in table.read().collect()] == [(1, "a")] and table.version() == 1
    with pytest.raises(ValueError, match="atomic"):
        StateTable(spark, "s3a://bucket/t", schema, ("id",))


def test_datasets_of_dead_writers_are_replaced(spark, tmp_path):
    """A folder without the writer's mark is written anew; a missing sidecar too."""
    bronze, raw = f"file://{tmp_path}/bronze", tmp_path / "raw"
    raw.mkdir()
    (raw / "ds_1.jsonl").write_text('{"id": "1"}\n{"id": "2"}\n')
    dead = f"{bronze}/ds_1.parquet"
    spark.createDataFrame([("half",)], "id string").write.parquet(dead)
    (tmp_path / "bronze" / "ds_1.parquet" / "_SUCCESS").unlink()
    assert import_ndjson(State(spark, f"file://{tmp_path}/state"), f"file://{raw}", bronze) == 1
    assert sorted(r.id for r in spark.read.parquet(dead).collect()) == ["1", "2"]
    assert import_ndjson(State(spark, f"file://{tmp_path}/state"), f"file://{raw}", bronze) == 0

    class Source:
        downloads = 0

        def trigger(self, config, token):
            return Run("r", "a")

        def wait(self, run, token):
            return "ds_2"

        def download(self, dataset_id, dest, token):
            self.downloads += 1
            from pathlib import Path

            Path(dest.removeprefix("file://")).write_text('{"id": "7"}\n')
            return 1

    source, path = Source(), tmp_path / "bronze" / "ds_2.parquet"
    spark.createDataFrame([("half",)], "id string").write.parquet(f"file://{path}")
    (path / "_SUCCESS").unlink()
    df = ingest(spark, source, ScrapeConfig(["u"]), bronze, "token")
    assert [r.id for r in df.collect()] == ["7"] and source.downloads == 1
    (tmp_path / "bronze" / "ds_2.parquet.meta").unlink()
    ingest(spark, source, ScrapeConfig(["u"]), bronze, "token")
    assert source.downloads == 1 and read_meta(spark, f"file://{path}")["item_count"] == 1


def test_overlapping_rows_are_there_if_pairs_are(spark):
    import random

    rng = random.Random(1)
    for _ in range(3):
        rows = [(k, f"o{rng.randrange(60)}", dt.datetime(2024, 1, 1 + rng.randrange(20)), None if rng.random() < 0.1 else dt.datetime(2024, 1, 1 + rng.randrange(20))) for k in range(150)]
        dim = spark.createDataFrame(rows, "profile_key int, owner_id string, effective_from timestamp_ntz, effective_to timestamp_ntz")
        pairs = {r.owner_id for r in checks.overlapping_intervals(dim).collect()}
        normal = {r.owner_id for r in checks.overlapping_rows(dim).collect()}
        assert normal == pairs
