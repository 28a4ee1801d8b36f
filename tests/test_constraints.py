"""Required values, defaults and foreign keys at commit."""

import pytest
from pyspark.sql import functions as F

from stratum.sources import state as state_module
from stratum.sources.files import listing
from stratum.sources.state import Constraints, MissingParent, MissingValue, StateTable

from .helpers import T0, lake_and_state


def tables(spark, folder):
    parents = StateTable(spark, f"file://{folder}/p", spark.createDataFrame([], "id int, v string").schema, ("id",), buckets=8, bucket_rows=100)
    schema = spark.createDataFrame([], "id int, parent int, note string").schema
    children = StateTable(spark, f"file://{folder}/c", schema, ("id",), buckets=2, constraints=Constraints(("note",), {"note": "none"}, ("parent", parents)))
    parents.upsert(spark.range(400).select(F.col("id").cast("int").alias("id"), F.lit("x").alias("v")))
    return parents, children


def child(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, parent int, note string")


def test_a_row_without_its_parent_is_refused_with_its_whole_commit(spark, tmp_path):
    parents, children = tables(spark, tmp_path)
    children.upsert(child(spark, (1, 5, "a"), (2, None, "b"), (3, 399, "c")))
    for rows in ([(4, 6, "d"), (5, 400, "e")], [(1, -1, "a")]):
        with pytest.raises(MissingParent):
            children.upsert(child(spark, *rows))
        with pytest.raises(MissingParent):
            children.merge(child(spark, *rows), lambda old, new: new)
    assert sorted(r.id for r in children.read().collect()) == [1, 2, 3] and children.version() == 1
    assert [f.name for f in listing(spark, children.path) if f.name.startswith("_v=")] == ["_v=1"]
    parents.upsert(spark.createDataFrame([(400, "later")], "id int, v string"))  # a delta run
    children.upsert(child(spark, (5, 400, "e")))
    parents.delete_where("id = 400")
    with pytest.raises(MissingParent):
        children.upsert(child(spark, (6, 400, "f")))


def test_a_key_is_looked_up_in_its_bucket_only(spark, tmp_path, monkeypatch):
    parents, children = tables(spark, tmp_path)
    loaded, real = [], StateTable._load

    def load(self, folders, schema=None):
        if self.path == parents.path:
            loaded.append((len(folders), schema and schema.names))
        return real(self, folders, schema)

    monkeypatch.setattr(StateTable, "_load", load)
    children.upsert(child(spark, (1, 7, "a")))
    assert loaded == [(1, ["id"])]
    with pytest.raises(MissingParent):  # out of the range of its bucket's keys: no run is read
        children.upsert(child(spark, (2, 1_000_000, "a")))
    assert loaded[1:] == [(0, ["id"])]


@pytest.mark.parametrize("bound", [0, 10**6])
def test_missing_keys_are_those_of_a_plain_difference(spark, tmp_path, monkeypatch, bound):
    parents, _ = tables(spark, tmp_path)
    monkeypatch.setattr(state_module, "BROADCAST_KEYS", bound)
    wanted = spark.range(350, 460).select(F.col("id").cast("int").alias("id"))
    assert sorted(r.id for r in parents.missing_keys(wanted, 110).collect()) == list(range(400, 460))
    assert parents.missing_keys(wanted.where("false"), 0).isEmpty()


def test_required_values_and_defaults(spark, tmp_path):
    _, children = tables(spark, tmp_path)
    with pytest.raises(MissingValue, match="note"):
        children.upsert(child(spark, (1, 5, "a"), (2, 5, None)))
    assert children.version() == 0
    children.upsert(spark.createDataFrame([(1, 5)], "id int, parent int"))
    assert children.read().first().note == "none"


def test_tables_of_the_pipeline_refuse_what_their_schema_forbids(spark, tmp_path):
    _, state = lake_and_state(spark, tmp_path)
    gold = spark.createDataFrame([("1", "{}")], "post_id string, result_json string")
    with pytest.raises(MissingParent):
        state.guarded("gold_ig_analyses").upsert(gold)
    state.guarded("silver_ig_posts").upsert(spark.createDataFrame([("1", "ds")], "post_id string, source_dataset string"))
    state.guarded("gold_ig_analyses").upsert(gold)
    assert state.table("gold_ig_analyses").read().first().schema_version == 3
    post = state.table("silver_ig_posts").read().first()
    assert (post.hashtags, post.has_engagement_bait, post.media_files, post.media_count) == ("[]", False, "[]", 0)
    with pytest.raises(MissingValue):
        state.guarded("silver_ig_posts").upsert(spark.createDataFrame([("2", None)], "post_id string, source_dataset string"))
    with pytest.raises(MissingValue):
        state.guarded("dim_profile").upsert(spark.createDataFrame([(1, None, T0)], "profile_key int, owner_id string, effective_from timestamp_ntz"))
