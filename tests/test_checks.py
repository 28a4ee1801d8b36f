import datetime as dt
import json

import pytest

from stratum.operators import checks
from stratum.schemas import DIM_PROFILE, GOLD, SILVER

from .helpers import GOOD

D = dt.datetime


def dim(spark, *intervals):
    return spark.createDataFrame([(i, owner, "n", "instagram", low, high, high is None) for i, (owner, low, high) in enumerate(intervals, 1)], DIM_PROFILE)


def gold(spark, *docs, version=3):
    return spark.createDataFrame([(str(i), version, d if d is None or isinstance(d, str) else json.dumps(d), D(2024, 1, 1)) for i, d in enumerate(docs)], GOLD)


JAN, JUN, JUL, DEC = D(2024, 1, 1), D(2024, 6, 1), D(2024, 7, 1), D(2024, 12, 31)


@pytest.mark.parametrize(
    "second_from, first_to, overlap, gap, valid",
    [(JUN, JUN, True, True, True), (JUN, DEC, False, False, True), (JUL, JUN, True, False, True)],
)
def test_intervals(spark, second_from, first_to, overlap, gap, valid):
    df = dim(spark, ("a", JAN, first_to), ("a", second_from, None), ("b", JAN, None))
    assert (checks.no_overlap(df).passed, checks.no_gaps(df).passed, checks.ranges_valid(df).passed) == (overlap, gap, valid)


def test_inverted_range(spark):
    result = checks.ranges_valid(dim(spark, ("a", JUN, JAN)))
    assert not result.passed and result.metadata == {"violations": 1, "first": ["a"]} and result.severity == "WARN"


def test_gold_checks(spark):
    good = gold(spark, GOOD)
    assert all(c(good).passed for c in checks.GOLD_CHECKS)
    bad = gold(spark, GOOD | {"admirality": "C3"}, None, "no json", [1], GOOD | {"educational_json": "text"}, GOOD | {"actionable_json": {"summary": ""}})
    assert checks.valid_codes(bad).metadata["violations"] == 4
    assert checks.valid_documents(bad).metadata["violations"] == 5
    assert not checks.current_version(gold(spark, GOOD, version=2)).passed and checks.current_version(gold(spark, GOOD, version=None)).passed


def test_counts(spark):
    silver = spark.createDataFrame([("1",) + (None,) * 17, ("1",) + (None,) * 17], SILVER)
    assert not checks.no_duplicates(silver).passed and checks.no_duplicates(silver.distinct()).passed
    assert checks.bounded_rows(silver.limit(1), silver).passed and not checks.bounded_rows(silver, silver.limit(1)).passed
    assert not checks.ids_not_null(silver).passed
    assert not checks.ids_not_null(spark.createDataFrame([(None,)], "id string")).passed and checks.ids_not_null(spark.createDataFrame([("x",)], "id string")).passed


def test_rows_meta_and_contract(spark):
    assert not checks.has_rows("x", None).passed and not checks.has_rows("x", spark.range(0)).passed and checks.has_rows("x", spark.range(1)).passed
    meta = {"run_id": "r", "actor": "a", "item_count": 1, "downloaded_at": "t"}
    assert checks.has_meta(meta).passed and not checks.has_meta(None).passed and checks.has_meta({"run_id": 1}).metadata["missing"] == ["actor", "downloaded_at", "item_count"]
    wide = spark.createDataFrame([], GOLD).selectExpr("*", "1 AS further")
    assert checks.schema_contract({"gold_ig_analyses": wide}).passed
    assert checks.schema_contract({"gold_ig_analyses": wide.drop("post_id")}).metadata["mismatches"] == ["gold_ig_analyses.post_id is missing"]
