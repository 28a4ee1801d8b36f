"""Commits over several tables, by the state's log."""

import datetime as dt

import pytest

from stratum.plans import gold as gold_plan
from stratum.plans.gold import run_gold
from stratum.plans.silver import run_silver
from stratum.sources.state import Log, State

from .helpers import T0, Fake, bronze, by_id, lake_and_state, post


def progress(spark, *rows):
    return spark.createDataFrame(rows, "source_dataset string, post_count int")


def test_commits_of_a_transaction_appear_together(spark, tmp_path):
    root = f"file://{tmp_path}/state"
    state, other = State(spark, root), State(spark, root)
    state.table("silver_ig_progress").upsert(progress(spark, ("a", 1)))
    with state.transaction():
        state.table("silver_ig_progress").upsert(progress(spark, ("b", 2)))
        state.table("silver_ig_progress").upsert(progress(spark, ("c", 3)))
        state.advance("m", T0)
        assert state.table("silver_ig_progress").read().count() == 3 and state.mark("m") == T0
        assert other.table("silver_ig_progress").read().count() == 1 and other.mark("m") is None and other.names() == ["silver_ig_progress"]
        with pytest.raises(RuntimeError), state.transaction():
            pass
    assert other.table("silver_ig_progress").read().count() == 3 and other.mark("m") == T0
    assert other.names() == ["silver_ig_progress", "watermarks"]


def test_a_failed_transaction_changes_nothing(spark, tmp_path):
    _, state = lake_and_state(spark, tmp_path)
    table = state.table("silver_ig_progress")
    table.upsert(progress(spark, ("a", 1)))
    for _ in range(3):
        with pytest.raises(ValueError), state.transaction():
            table.upsert(progress(spark, ("a", 9)))
            table.upsert(progress(spark, ("b", 9)))
            state.advance("m", T0)
            raise ValueError
    assert [tuple(r)[:2] for r in table.read().collect()] == [("a", 1)] and state.mark("m") is None
    table.upsert(progress(spark, ("c", 3)))
    assert {r.source_dataset for r in table.read().collect()} == {"a", "c"} and table.version() == 2


def test_entries_of_two_writers_are_both_kept(spark, tmp_path):
    log, again = Log(spark, f"file://{tmp_path}/s"), Log(spark, f"file://{tmp_path}/s")
    log.append({"a": 1})
    taken, real = [], again._numbers

    def numbers():  # the other writer comes first, once
        found = real()
        if not taken:
            taken.append(True)
            log.append({"b": 7})
        return found

    again._numbers = numbers
    again.append({"c": 3})
    assert log.current() == {"a": 1, "b": 7, "c": 3}
    for i in range(30):
        log.append({"a": i})
    assert len(log._numbers()) <= Log.KEPT + 1 and log.current() == {"a": 29, "b": 7, "c": 3}


STEPS = ("gold_ig_analyses", "dead_letter", "watermarks")


@pytest.mark.parametrize("step", range(3))
def test_gold_that_crashes_leaves_all_three_tables_as_they_were(spark, tmp_path, monkeypatch, step):
    lake, state = lake_and_state(spark, tmp_path)
    bronze(spark, lake, "ds", [post("1", "good"), post("2", ""), post("3", "always fails")])
    run_silver(lake, state, T0)
    before = {t: state.table(t).version() for t in STEPS}
    real = State.table

    def table(self, name):
        if name == STEPS[step] and self.open_versions is not None and len(self.open_versions) == step:
            raise RuntimeError("crash")
        return real(self, name)

    monkeypatch.setattr(State, "table", table)
    with pytest.raises(RuntimeError, match="crash"):
        run_gold(state, Fake, T0 + dt.timedelta(days=1), gold_plan.EnrichConfig(backoff_seconds=0.0))
    monkeypatch.setattr(State, "table", real)
    assert {t: State(spark, lake.state).table(t).version() for t in STEPS} == before
    run_gold(state, Fake, T0 + dt.timedelta(days=1), gold_plan.EnrichConfig(backoff_seconds=0.0))
    assert set(by_id(state.table("gold_ig_analyses").read())) == {"1"} and set(by_id(state.table("dead_letter").read())) == {"2", "3"}
    assert {t: state.table(t).version() for t in STEPS} == {t: v + 1 for t, v in before.items()}
