"""Runs whose analyzer's quota ends."""

import datetime as dt
from collections import Counter
from functools import partial

from stratum.config import EnrichConfig
from stratum.operators.enrich import QuotaExceeded
from stratum.plans.gold import run_gold
from stratum.plans.silver import run_silver

from .helpers import T0, Fake, bronze, by_id, lake_and_state, post

T1 = T0 + dt.timedelta(hours=1)
ALL = {"backoff_seconds": 0.0, "batch_limit": None, "parallelism": 2}


class Metered(Fake):
    """Takes some calls in each task of a round."""

    def __init__(self, log, quota, wait=None):
        super().__init__(log)
        self.left, self.wait = quota, wait

    def analyze(self, prompt):
        if not self.left:
            raise QuotaExceeded(retry_after=self.wait)
        self.left -= 1
        return super().analyze(prompt)


def start(spark, folder, captions):
    lake, state = lake_and_state(spark, folder)
    bronze(spark, lake, "ds", [post(str(i), c) for i, c in enumerate(captions)])
    run_silver(lake, state, T0)
    return state, str(folder / "calls")


def sent(log):
    return Counter(open(log).read().split("\n")[:-1])


def test_rounds_go_on_after_pauses_and_send_each_row_once(spark, tmp_path):
    state, log = start(spark, tmp_path, [f"c{i}" for i in range(12)] + ["", "always fails"])
    waits: list[float] = []
    gold = run_gold(state, partial(Metered, log, 3, 7.0), T1, EnrichConfig(quota_pauses=20, **ALL), sleep=waits.append)
    assert set(by_id(gold)) == {str(i) for i in range(12)} and waits and set(waits) == {7.0}
    assert {k: (v.status, v.attempts) for k, v in by_id(state.table("dead_letter").read()).items()} == {"12": ("skipped", 0), "13": ("pending", 3)}
    assert all(sent(log)[f"c{i}"] == 1 for i in range(12)) and state.mark("gold_ig") == T0


def test_rows_that_were_not_tried_stay_pending_without_a_letter(spark, tmp_path):
    for compat in (False, True):
        folder = tmp_path / str(compat)
        folder.mkdir()
        state, log = start(spark, folder, [f"c{i}" for i in range(10)] + [" "])
        waits: list[float] = []
        config = EnrichConfig(quota_pauses=1, quota_wait=5.0, quota_wait_max=4.0, compat=compat, **ALL)
        first = set(by_id(run_gold(state, partial(Metered, log, 2), T1, config, sleep=waits.append)))
        assert 4 <= len(first) <= 8 and waits == [4.0] and sum(sent(log).values()) == len(first)
        assert set(by_id(state.table("dead_letter").read())) == {"10"} and state.mark("gold_ig") is None
        assert len(by_id(run_gold(state, partial(Fake, log), T1 + dt.timedelta(hours=1), config))) == 10
        if not compat:  # which sends again what lies after the mark
            assert set(sent(log).values()) == {1}


def test_a_round_without_an_answer_ends_the_run(spark, tmp_path):
    state, log = start(spark, tmp_path, ["a", "b", "c"])
    waits: list[float] = []
    assert run_gold(state, partial(Metered, log, 0), T1, EnrichConfig(quota_pauses=9, **ALL), sleep=waits.append).isEmpty()
    assert not waits and state.table("dead_letter").read().isEmpty() and state.mark("gold_ig") is None


def test_short_waits_are_passed_by_the_task_within_the_allowed_pauses(spark, tmp_path):
    for pauses, answered in ((1000, 60), (3, None)):
        folder = tmp_path / str(pauses)
        folder.mkdir()
        state, log = start(spark, folder, [f"c{i}" for i in range(60)])
        waits: list[float] = []
        gold = run_gold(state, partial(Metered, log, 2, 0.0), T1, EnrichConfig(quota_pauses=pauses, **ALL), sleep=waits.append)
        n = len(by_id(gold))
        assert not waits and set(sent(log).values()) == {1} and sum(sent(log).values()) == n
        assert n == answered if answered else 8 <= n <= 16
        assert state.mark("gold_ig") == (T0 if answered else None)


def test_what_rounds_read_grows_with_the_rows_and_not_with_the_rounds(spark, tmp_path, monkeypatch):
    from stratum.operators import enrich
    from stratum.plans import gold

    monkeypatch.setattr(gold, "ROUND_ROWS", 3)
    state, log = start(spark, tmp_path, [f"c{i:02d}" for i in range(40)])
    read, analyze = [], enrich.analyze
    monkeypatch.setattr(enrich, "analyze", lambda posts, *a, **k: (read.append(posts.count()), analyze(posts, *a, **k))[1])
    waits: list[float] = []
    assert len(by_id(run_gold(state, partial(Metered, log, 2, 7.0), T1, EnrichConfig(quota_pauses=100, **ALL), sleep=waits.append))) == 40
    assert set(sent(log).values()) == {1} and len(read) >= 10 and max(read) <= 8 and sum(read) <= 2 * 40 + 6
