import datetime as dt
from collections import Counter
from functools import partial

import pytest

from stratum.config import EnrichConfig
from stratum.operators.enrich import analyze_once
from stratum.plans.gold import config_hash, run_gold
from stratum.plans.silver import run_silver

from .helpers import T0, Fake, bronze, by_id, lake_and_state, post

T1 = T0 + dt.timedelta(hours=1)
FAST = {"backoff_seconds": 0.0}


def start(spark, folder, captions):
    lake, state = lake_and_state(spark, folder)
    bronze(spark, lake, "ds", [post(str(i), c) for i, c in enumerate(captions)])
    run_silver(lake, state, T0)
    return state


def test_success_blank_and_failure_are_routed(spark, tmp_path):
    state = start(spark, tmp_path, ["fine", "", "   \n", None, "always fails", "not json"])
    gold = by_id(run_gold(state, Fake, T1, EnrichConfig(**FAST)))
    assert set(gold) == {"0"} and gold["0"].schema_version == 3 and gold["0"].analysed_at == T1
    dead = by_id(state.table("dead_letter").read())
    assert {k: (v.status, v.attempts) for k, v in dead.items()} == {"1": ("skipped", 0), "2": ("skipped", 0), "3": ("skipped", 0), "4": ("pending", 3), "5": ("pending", 3)}
    assert dead["4"].error == "service down"


def test_a_row_is_sent_once(spark, tmp_path):
    log = str(tmp_path / "calls")
    state = start(spark, tmp_path, ["a", "b", "fails once"])
    run_gold(state, partial(Fake, log), T1, EnrichConfig(**FAST))
    assert Counter(open(log).read().split("\n")[:-1]) == {"a": 1, "b": 1, "fails once": 2}
    assert state.table("gold_ig_analyses").read().count() == 3


def test_retry_waits_and_counts():
    waits: list[float] = []
    assert analyze_once(Fake(), "always fails", 3, 2.0, waits.append)[0::3] == (False, 3) and waits == [2.0, 4.0]
    assert analyze_once(Fake(), "Post:\nfails once", 3, 0.0)[0] is True


@pytest.mark.parametrize("compat, second", [(False, 15), (True, 10)])
def test_batch_limit(spark, tmp_path, compat, second):
    state = start(spark, tmp_path, [f"c{i}" for i in range(15)])
    config = EnrichConfig(compat=compat, **FAST)
    assert run_gold(state, Fake, T1, config).count() == 10
    assert run_gold(state, Fake, T1 + dt.timedelta(hours=1), config).count() == second


def test_mark_reset_reprocesses_and_dead_letters_accumulate(spark, tmp_path):
    state = start(spark, tmp_path, ["a", "always fails"])
    run_gold(state, Fake, T1, EnrichConfig(**FAST))
    assert state.mark("gold_ig") == T0
    run_gold(state, Fake, T1 + dt.timedelta(hours=1), EnrichConfig(**FAST))
    assert by_id(state.table("dead_letter").read())["1"].attempts == 3
    state.reset("gold_ig")
    config = EnrichConfig(compat=True, **FAST)
    gold = run_gold(state, Fake, T1 + dt.timedelta(hours=2), config)
    assert by_id(gold)["0"].analysed_at == T1 + dt.timedelta(hours=2)
    assert by_id(state.table("dead_letter").read())["1"].attempts == 6


def test_post_ids_restrict_a_run_and_leave_the_mark(spark, tmp_path):
    state = start(spark, tmp_path, ["a", "b", "c"])
    assert set(by_id(run_gold(state, Fake, T1, EnrichConfig(post_ids=["1"], **FAST)))) == {"1"}
    assert state.mark("gold_ig") is None


def test_marks_are_generic_and_keep_their_hash(spark, tmp_path):
    _, state = lake_and_state(spark, tmp_path)
    state.advance("other", T0, "h")
    state.advance("other", T1)
    row = state.table("watermarks").read().first()
    assert (row.timestamp, row.config_hash) == (T1, "h") and config_hash("m") == config_hash("m") != config_hash("n")
