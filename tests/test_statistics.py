"""Counts that commits note, against scans."""

from pyspark.sql import functions as F

from stratum.plans.pipeline import Pipeline
from stratum.schemas import SILVER
from stratum.sources.files import listing
from stratum.sources.state import StateTable

from .helpers import T0, bronze, lake_and_state, post

SCHEMA = "id int, source_dataset string, v int"


def table(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return StateTable(spark, f"file://{folder}/t", schema, ("id",), buckets=2, bucket_rows=20, counted="source_dataset")


def rows(spark, ids, dataset, v=0):
    return spark.createDataFrame([(i, dataset, v) for i in ids], SCHEMA)


def noted(t):
    """Counts of the current version, which must be noted and be those of a scan."""
    assert t._manifest(t.version()).get("counts") is not None
    found = {r.source_dataset: r.n_rows for r in t.counts().collect()}
    assert found == {r.source_dataset: r["count"] for r in t.read().groupBy("source_dataset").count().collect()} and t.n_rows() == sum(found.values())
    return found


def test_counts_follow_every_kind_of_commit(spark, tmp_path):
    t, newer = table(spark, tmp_path), lambda old, new: new
    assert t.n_rows() == 0 and t.counts().count() == 0
    t.merge(rows(spark, range(30), "a"), newer)
    assert noted(t) == {"a": 30}
    t.merge(rows(spark, range(20, 45), None), newer)  # moves ten rows, and buckets split
    assert noted(t) == {"a": 20, None: 25} and len(t.runs()) > 2
    t.merge(rows(spark, range(20), "a", 7), newer)  # changes rows that stay where they are counted
    assert noted(t) == {"a": 20, None: 25}
    t.merge(rows(spark, range(20), "a", 7), newer)  # changes nothing
    assert noted(t) == {"a": 20, None: 25}
    t.delete_where("id < 5")
    assert noted(t) == {"a": 15, None: 25}
    t.delete_keys(rows(spark, [5, 6, 44, 99], "x"))
    assert noted(t) == {"a": 13, None: 24}
    t.merge(rows(spark, range(45), "b"), newer)
    assert noted(t) == {"b": 45}  # a dataset without rows isn't listed
    t.replace(rows(spark, range(3), "c"))
    assert noted(t) == {"c": 3}
    folders = [f.name for f in listing(spark, t.path) if f.name.startswith("_counts-")]
    assert sorted(folders) == [f"_counts-{t.version() - 1}", f"_counts-{t.version()}"]


def test_an_upsert_leaves_counts_out_and_the_next_merge_makes_them_anew(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(rows(spark, range(10), "a"))
    assert noted(t) == {"a": 10}  # of the first version
    t.upsert(rows(spark, range(5, 15), "b"))
    assert t._manifest(t.version()).get("counts") is None and t.n_rows() == 15
    assert {r.source_dataset: r.n_rows for r in t.counts().collect()} == {"a": 5, "b": 10}
    t.merge(rows(spark, [0], "b"), lambda old, new: new)
    assert noted(t) == {"a": 4, "b": 11}


def test_a_failed_commit_leaves_counts_as_they_were(spark, tmp_path):
    _, state = lake_and_state(spark, tmp_path)
    posts = state.table("silver_ig_posts")
    one = lambda i, d: spark.createDataFrame([(str(i), d)], "post_id string, source_dataset string").select(*(c if c in ("post_id", "source_dataset") else F.lit(None).cast(SILVER[c].dataType).alias(c) for c in SILVER.names))
    posts.merge(one(1, "a"), lambda old, new: new)
    try:
        with state.transaction():
            posts.merge(one(2, "b"), lambda old, new: new)
            assert noted(posts) == {"a": 1, "b": 1}
            raise RuntimeError
    except RuntimeError:
        pass
    assert noted(posts) == {"a": 1}
    posts.merge(one(3, "c"), lambda old, new: new)
    assert noted(posts) == {"a": 1, "c": 1}


def test_silver_checks_read_no_posts(spark, tmp_path, monkeypatch):
    lake, state = lake_and_state(spark, tmp_path)
    bronze(spark, lake, "one", [post(str(i)) for i in range(6)])
    bronze(spark, lake, "two", [post(str(i)) for i in range(4, 9)])
    pipeline = Pipeline(spark, lake)
    pipeline.run(T0, steps=("silver",))
    progress = {r.source_dataset: r.post_count for r in state.table("silver_ig_progress").read().collect()}
    assert progress == {"one": 4, "two": 5}
    read = StateTable.read

    def refuse(self, *args, **kwargs):
        assert not self.path.endswith("/silver_ig_posts")
        return read(self, *args, **kwargs)

    monkeypatch.setattr(StateTable, "read", refuse)
    results = {c.name: c for c in pipeline.silver_checks()}
    assert all(c.passed for c in results.values()) and results["ig_posts_slv_row_count_bounded"].metadata["n_part"] == 9
    monkeypatch.setattr(StateTable, "keys_checked", lambda self: False)
    monkeypatch.setattr(StateTable, "read", read)
    assert {c.name: dict(c.metadata) for c in pipeline.silver_checks()}["ig_posts_slv_no_duplicates"] == {"total": 9, "distinct_keys": 9}
