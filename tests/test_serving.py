import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratum.operators.dates import date_dimension
from stratum.operators.scd2 import apply_names, dense_numbers, observed_names
from stratum.plans.serving import run_dim_profile, run_dim_time, run_view
from stratum.plans.silver import run_silver
from stratum.schemas import ANALYTICS_VIEW, DIM_PROFILE
from stratum.session import shared_folder

from .helpers import T0, bronze, by_id, lake_and_state, post

T1 = T0 + dt.timedelta(days=1)


def dim_after(spark, dim, names, when):
    seen = spark.createDataFrame(names, "owner_id string, owner_username string, last_seen timestamp_ntz")
    return apply_names(dim, seen, F.lit(when))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_first_run_opens_a_chain_and_second_run_changes_nothing(spark):
    empty = spark.createDataFrame([], DIM_PROFILE)
    names = [("a", "old", dt.datetime(2024, 1, 1)), ("a", "new", dt.datetime(2024, 2, 1)), ("b", None, None)]
    first = dim_after(spark, empty, names, T0)
    assert rows(first) == [(1, "a", "old", "instagram", T0, T0, False), (2, "a", "new", "instagram", T0, None, True), (3, "b", None, "instagram", T0, None, True)]
    assert rows(dim_after(spark, first, names, T1)) == rows(first)


def test_change_closes_and_opens(spark, tmp_path):
    lake, state = lake_and_state(spark, tmp_path)
    bronze(spark, lake, "ds_1", [post("1", owner="a", user="old_name"), post("2", owner="b", user="same")])
    run_silver(lake, state, T0)
    run_dim_profile(state, T0)
    import time

    time.sleep(1.1)
    bronze(spark, lake, "ds_2", [post("1", timestamp="2024-06-01T00:00:00Z", owner="a", user="new_name")])
    run_silver(lake, state, T1)
    dim = rows(run_dim_profile(state, T1))
    assert dim == [(1, "a", "old_name", "instagram", T0, T1, False), (2, "b", "same", "instagram", T0, None, True), (3, "a", "new_name", "instagram", T1, None, True)]
    view = by_id(run_view(state))
    assert view["1"].profile_key == 3 and view["1"].result_json is None and spark.table("analytics_views").schema == ANALYTICS_VIEW


def fold(dim, names, when):
    """One name after the other, as a loop over rows would do it."""
    dim = [list(r) for r in dim]
    key = max((r[0] for r in dim), default=0)
    by_owner: dict = {}
    for owner, name, seen in names:
        by_owner.setdefault(owner, []).append((seen is not None, seen or T0, name is not None, name or "", name))
    for owner in sorted(by_owner):
        own = sorted(by_owner[owner])
        current = next((r for r in dim if r[1] == owner and r[6]), None)
        if current and current[2] == own[-1][-1]:
            continue
        for *_, name in own:
            if current and current[2] == name:
                continue
            if current:
                current[5], current[6] = when, False
            key += 1
            current = [key, owner, name, "instagram", when, None, True]
            dim.append(current)
    return sorted(map(tuple, dim))


@pytest.mark.parametrize("seed", range(4))
def test_chain_matches_a_fold(spark, seed):
    rng = random.Random(seed)
    dim = spark.createDataFrame([], DIM_PROFILE)
    expected: list = []
    for step in range(2):
        names = {(rng.choice("abcd"), rng.choice(["x", "y", "z", None])): rng.choice([None, T0, T1, T1 + dt.timedelta(days=1)]) for _ in range(8)}
        names = [(o, n, s) for (o, n), s in names.items()]
        when = T0 + dt.timedelta(days=step)
        expected = fold(expected, names, when)
        dim = dim_after(spark, dim, names, when)
        assert rows(dim) == expected
        dim = spark.createDataFrame(dim.collect(), DIM_PROFILE)


def test_observed_names_leave_out_unknown_owners(spark):
    df = spark.createDataFrame([(None, "x", T0), ("a", "x", T0), ("a", "x", T1)], "owner_id string, owner_username string, timestamp timestamp_ntz")
    assert rows(observed_names(df)) == [("a", "x", T1)]


def test_date_dimension(spark, tmp_path):
    _, state = lake_and_state(spark, tmp_path)
    days = run_dim_time(state, dt.date(2024, 2, 28), dt.date(2024, 3, 2))
    assert [r.date_key for r in days.orderBy("date").collect()] == [20240228, 20240229, 20240301, 20240302]
    last = days.orderBy(F.desc("date")).first()
    assert (last.year, last.quarter, last.month, last.day, last.day_of_week, last.is_weekend) == (2024, 1, 3, 2, 6, True)
    assert date_dimension(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1)).isEmpty()


@pytest.mark.parametrize("prefix", ["", "17841400"])
def test_numbers_are_dealt_by_even_ranges(spark, prefix):
    """Ids with a common beginning are numbered in as many tasks as others."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    folder = Path(shared_folder(spark).removeprefix("file://"))
    before = set(folder.glob("numbers-*"))
    try:
        ids = F.when(F.col("id") % 500 > 0, F.concat(F.lit(prefix), (F.col("id") * 7919 % 4001).cast("string")))
        df = spark.range(4000).select(ids.alias("owner_id"), F.col("id").alias("seq"))
        numbered = dense_numbers(df, "owner_id", "seq")
        assert numbered.columns == ["owner_id", "seq", "number"]
        got = sorted(map(tuple, numbered.collect()), key=lambda r: r[2])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert got == [(*r, i + 1) for i, r in enumerate(want)]
    (written,) = set(folder.glob("numbers-*")) - before
    sizes = [spark.read.parquet(str(f)).count() for f in written.glob("*.parquet")]
    assert len(sizes) == 4 and max(sizes) < 2000
