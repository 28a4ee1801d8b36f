"""Data-quality checks.

A check counts violations, or compares counts, in one small aggregate; it
warns and never blocks.  The functions that find violations are also of use
by themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import has_summarised_object, json_field
from ..schemas import ADMIRALITY_CODES, ANALYSIS_VERSION, mismatches

# Names of checks and of their metadata below are fixed values that dashboards rely on.
FAR_PAST, FAR_FUTURE = "1970-01-01 00:00:00", "9999-12-31 00:00:00"
REQUIRED_META = ("run_id", "actor", "item_count", "downloaded_at")


@dataclass(frozen=True)
class CheckResult:
    name: str
    passed: bool
    description: str
    metadata: Mapping[str, object] = field(default_factory=dict)
    severity: str = "WARN"


# --- violations -------------------------------------------------------------


def _timed(dim: DataFrame) -> DataFrame:
    """(owner_id, profile_key, low, high) with open ends filled, and the largest end of the owner's rows that begin before."""
    low, high = (F.coalesce(c, F.lit(end).cast("timestamp_ntz")) for c, end in (("effective_from", FAR_PAST), ("effective_to", FAR_FUTURE)))
    return dim.select("owner_id", "profile_key", low.alias("low"), high.alias("high"))


def _begin_too_early(timed: DataFrame) -> DataFrame:
    """Rows that begin before an earlier one of their owner has ended, among those that end after they begin."""
    before = Window.partitionBy("owner_id").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    return timed.where("low < high").withColumn("reach", F.max("high").over(before)).where("low < reach")


def _pairs(own: DataFrame) -> DataFrame:
    a, b = own.alias("a"), own.alias("b")
    pairs = a.join(b, (F.col("a.owner_id") == F.col("b.owner_id")) & (F.col("a.profile_key") < F.col("b.profile_key")) & (F.col("a.low") < F.col("b.high")) & (F.col("b.low") < F.col("a.high")))
    return pairs.select(F.col("a.owner_id").alias("owner_id"), F.col("a.profile_key").alias("key_a"), F.col("b.profile_key").alias("key_b"))


def overlapping_intervals(dim: DataFrame) -> DataFrame:
    """(owner_id, key_a, key_b): pairs of rows of an owner whose half-open intervals overlap.

    Sorted by start, an interval overlaps a later one if any does not end
    before the next begins; only owners with such rows are joined with
    themselves, so owners without violations cost a sort and no pairs.
    """
    timed = _timed(dim)
    # Empty or inverted intervals can overlap too (low < other.high and other.low < high); they are rare.
    suspects = _begin_too_early(timed).select("owner_id").union(timed.where("low >= high").select("owner_id")).distinct()
    return _pairs(timed.join(suspects, "owner_id", "left_semi"))


def overlapping_rows(dim: DataFrame) -> DataFrame:
    """(owner_id, profile_key) of rows that overlap an earlier one of their owner: a sort for each owner, and no pairs.

    There is such a row if and only if there is a pair of `overlapping_intervals`.
    An empty or inverted interval overlaps those that hold it: that begin before
    its end and end after its start.
    """
    timed = _timed(dim)
    normal = _begin_too_early(timed).select("owner_id", "profile_key")
    odd = timed.where("low >= high").select("owner_id", "profile_key", F.col("high").alias("starts"), F.col("low").alias("ends"))
    # For each odd one, the largest end of the normal ones that begin before its end.
    marks = timed.where("low < high").select("owner_id", F.col("low").alias("at"), F.col("high").alias("reach"), F.lit(None).cast("int").alias("profile_key"), F.lit(None).cast("timestamp_ntz").alias("ends"), F.lit(1).alias("kind"))
    marks = marks.unionByName(odd.select("owner_id", F.col("starts").alias("at"), F.lit(None).cast("timestamp_ntz").alias("reach"), "profile_key", "ends", F.lit(0).alias("kind")))
    before = Window.partitionBy("owner_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, -1)
    held = marks.withColumn("reach", F.max("reach").over(before)).where("kind = 0 AND ends < reach").select("owner_id", "profile_key")
    return normal.unionByName(held)


def inverted_ranges(dim: DataFrame) -> DataFrame:
    """Rows that end before they begin."""
    return dim.where("effective_to IS NOT NULL AND effective_from > effective_to")


def gaps(dim: DataFrame) -> DataFrame:
    """Rows that don't begin where the owner's row before ended."""
    order = Window.partitionBy("owner_id").orderBy("effective_from", "profile_key")
    return dim.withColumn("previous_to", F.lag("effective_to").over(order)).where("previous_to IS NOT NULL AND effective_from <> previous_to")


def invalid_codes(gold: DataFrame) -> DataFrame:
    """Analyses without a valid admirality code."""
    valid = F.coalesce(json_field(F.col("result_json"), "admirality").isin(*ADMIRALITY_CODES), F.lit(False))
    return gold.where(~valid)


def incomplete_documents(gold: DataFrame) -> DataFrame:
    """Analyses that lack one of the two objects with a summary."""
    text = F.col("result_json")
    return gold.where(~(has_summarised_object(text, "educational_json") & has_summarised_object(text, "actionable_json")))


def outdated(gold: DataFrame, version: int = ANALYSIS_VERSION) -> DataFrame:
    """Analyses of another schema version; an unknown version is none."""
    return gold.where(F.col("schema_version") != version)


# --- counts -----------------------------------------------------------------


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    """One row: total, distinct."""
    return df.agg(F.count("*").alias("total"), F.count_distinct(key).alias("distinct_keys"))


def null_count(df: DataFrame, column: str) -> DataFrame:
    """One row: nulls of a column."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("n_null"))


def row_bound(part: DataFrame, whole: DataFrame) -> DataFrame:
    """One row: rows of both tables, and whether the first has at most as many."""
    n = part.agg(F.count("*").alias("n_part")).join(F.broadcast(whole.agg(F.count("*").alias("n_whole"))))  # one row each
    return n.select("n_part", "n_whole", (F.col("n_part") <= F.col("n_whole")).alias("bounded"))


# --- results ----------------------------------------------------------------


def _none(name: str, description: str, found: DataFrame, shown: str | None = None) -> CheckResult:
    """A check that passes without violations; some of them are in the metadata."""
    n = found.count()
    metadata: dict[str, object] = {"violations": n}
    if n and shown:
        metadata["first"] = [r[0] for r in found.select(shown).orderBy(shown).limit(5).collect()]
    return CheckResult(name, n == 0, description, metadata)


def has_rows(name: str, df: DataFrame | None) -> CheckResult:
    """A table that can be read and isn't empty (None: it can't)."""
    return CheckResult(name, df is not None and not df.isEmpty(), "has rows")


def has_meta(meta: Mapping[str, object] | None) -> CheckResult:
    """The sidecar of an ingested dataset is there and complete."""
    missing = sorted(set(REQUIRED_META) - set(meta)) if meta is not None else list(REQUIRED_META)
    return CheckResult("ig_posts_raw_has_meta", not missing, "sidecar with all fields", {"missing": missing})


def ids_not_null(bronze: DataFrame) -> CheckResult:
    name, description = "ig_posts_raw_run_id_not_null", "column id without nulls"
    if "id" not in bronze.columns:
        return CheckResult(name, False, description, {"missing": "id"})
    n = null_count(bronze, "id").first()[0]
    return CheckResult(name, n == 0, description, {"nulls": n})


def no_duplicates(silver: DataFrame) -> CheckResult:
    n = duplicate_counts(silver, "post_id").first()
    return CheckResult("ig_posts_slv_no_duplicates", n.total == n.distinct_keys, "a row for each post", n.asDict())


def unique_by_commits(n_rows: int) -> CheckResult:
    """The same for rows whose keys were checked by the commits that wrote them."""
    return CheckResult("ig_posts_slv_no_duplicates", True, "a row for each post", {"total": n_rows, "distinct_keys": n_rows})


def bounded_rows(silver: DataFrame, bronze: DataFrame) -> CheckResult:
    n = row_bound(silver, bronze).first()
    return CheckResult("ig_posts_slv_row_count_bounded", n.bounded, "not more posts than bronze rows", n.asDict())


def bounded_count(n: int, n_whole: int) -> CheckResult:
    """The same for numbers that are known."""
    return CheckResult("ig_posts_slv_row_count_bounded", n <= n_whole, "not more posts than bronze rows", {"n_part": n, "n_whole": n_whole, "bounded": n <= n_whole})


def valid_codes(gold: DataFrame) -> CheckResult:
    return _none("ig_posts_gld_valid_admiralty", "valid admirality codes", invalid_codes(gold), "post_id")


def valid_documents(gold: DataFrame) -> CheckResult:
    return _none("ig_posts_gld_valid_json", "complete JSON documents", incomplete_documents(gold), "post_id")


def current_version(gold: DataFrame) -> CheckResult:
    return _none("ig_posts_gld_schema_version_current", "current schema version", outdated(gold), "post_id")


def no_overlap(dim: DataFrame) -> CheckResult:
    return _none("dim_profile_no_overlapping_intervals", "intervals of an owner are disjoint", overlapping_rows(dim), "owner_id")


def ranges_valid(dim: DataFrame) -> CheckResult:
    return _none("dim_profile_effective_range_valid", "no interval ends before it begins", inverted_ranges(dim), "owner_id")


def no_gaps(dim: DataFrame) -> CheckResult:
    return _none("dim_profile_no_gaps", "intervals of an owner join", gaps(dim), "owner_id")


def schema_contract(tables: Mapping[str, DataFrame], views: Mapping[str, Callable[[], DataFrame]] | None = None) -> CheckResult:
    """Every table that is there has the columns and types of its schema, and every view can be queried."""
    found = [m for name, df in tables.items() for m in mismatches(name, df.schema)]
    for name, view in (views or {}).items():
        try:
            view().isEmpty()
        except Exception as problem:  # noqa: BLE001  whatever keeps a query from running is the finding
            found.append(f"{name} can't be queried: {str(problem).splitlines()[0]}")
    return CheckResult("state_schema_contract", not found, "columns and types as declared", {"mismatches": found})


INGEST_CHECKS: tuple[Callable, ...] = (has_rows, has_meta, ids_not_null)
SILVER_CHECKS: tuple[Callable, ...] = (no_duplicates, bounded_rows)
GOLD_CHECKS: tuple[Callable, ...] = (valid_codes, valid_documents, current_version)
SERVING_CHECKS: tuple[Callable, ...] = (no_overlap, ranges_valid, no_gaps, has_rows)
