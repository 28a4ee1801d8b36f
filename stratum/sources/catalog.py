"""A stored catalog of bronze files, and the datasets that are kept back.

The catalog has a row for each file: its size, time, rows and schema, as its
footer said when it was first seen.  A run lists the folder, opens the footers
of files that are new or changed, and forgets those that are gone; all other
files are known.  Counts of bronze rows come from it, so they are those of the
files that lie there, however their rows came into the posts.

A dataset is taken as a whole or not at all.  One with a file that can't be
read, or of which a scan gave fewer rows than the footers promise, goes to
quarantine with the reason, and is tried again by each run until it is whole.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bronze import FILE, footers, list_files
from .files import delete, exists, qualified
from .state import State

CATALOG, QUARANTINE = "bronze_catalog", "bronze_quarantine"
#: Places of a dataset's files below the folder.
_PLACES = r"^([^/]+\.parquet|dataset_id=[^/]+/[^/]+\.parquet|[^/]+\.parquet/[^/]+\.parquet)$"


def refresh(state: State, bronze: str) -> DataFrame:
    """Bring the catalog up to the folder; (FOOTERS) of all files that lie there now.  Known files aren't opened."""
    table, spark = state.table(CATALOG), state.spark
    root = qualified(spark, bronze)
    listed = list_files(spark, *([root] if exists(spark, bronze) else []))
    listed = listed.where(F.substring(F.col("path"), len(root) + 2, 1 << 20).rlike(_PLACES))
    staging = f"{state.root}/_staging/listing"
    listed.write.mode("overwrite").parquet(staging)  # one listing for all that follows
    listed = spark.read.schema(listed.schema).parquet(staging)
    known, same = table.read(), ["file", "modified_ms", "n_bytes"]
    gone = known.join(listed, "file", "left_anti").select("file")
    if not gone.isEmpty():
        table.delete_keys(gone)
    fresh = listed.join(known.where("error IS NULL").select(*same), same, "left_anti")  # files in error are looked at again
    if not fresh.isEmpty():
        table.upsert(footers(fresh))
    delete(spark, staging)
    return table.read()


def bronze_rows(catalog: DataFrame) -> int:
    """Rows of all files that can be read."""
    return catalog.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]


def pending_files(catalog: DataFrame, quarantined: DataFrame, after_ms: int | None) -> DataFrame:
    """Files of the datasets with a file that is newer than a mark, and of those in quarantine."""
    newest = catalog.groupBy("dataset_id").agg(F.max("modified_ms").alias("newest"))
    due = newest if after_ms is None else newest.where(F.col("newest") > after_ms)
    due = due.select("dataset_id").unionByName(quarantined.select("dataset_id")).distinct()
    return catalog.join(due, "dataset_id", "left_semi")


def short_datasets(scanned: DataFrame, files: DataFrame) -> DataFrame:
    """(dataset_id, n_expected, n_found, file): datasets of which a scan gave other counts than the footers, with their first such file.

    `scanned` has a row (FILE) for each row that was read.
    """
    found = scanned.groupBy(F.col(FILE).alias("file")).agg(F.count("*").alias("n_found"))
    told = files.select("dataset_id", "file", "path", F.col("n_rows").alias("n_expected")).join(found, "file", "left").withColumn("n_found", F.coalesce("n_found", F.lit(0)))
    by_dataset = told.groupBy("dataset_id").agg(F.sum("n_expected").alias("n_expected"), F.sum("n_found").alias("n_found"), F.min(F.when(F.col("n_found") != F.col("n_expected"), F.col("path"))).alias("path"))
    return by_dataset.where("path IS NOT NULL")


def keep_back(state: State, reasons: dict[str, tuple[str, int | None, int | None]], tried: list[str], run_ts: dt.datetime) -> None:
    """Put damaged datasets into quarantine, with (reason, rows promised, rows found), and let those that were tried and are whole go."""
    table, spark = state.table(QUARANTINE), state.spark
    before = table.read()
    if released := sorted(set(tried) - set(reasons)):
        hit = before.where(F.col("dataset_id").isin(released)).select("dataset_id")
        if not hit.isEmpty():
            table.delete_keys(hit)
    if reasons:
        rows = spark.createDataFrame([(d, *r) for d, r in reasons.items()], "dataset_id string, reason string, n_expected long, n_found long")
        first = before.select("dataset_id", F.col("first_seen").alias("since"))
        stamp = F.lit(run_ts).cast("timestamp_ntz")
        table.upsert(rows.join(first, "dataset_id", "left").select(*rows.columns, F.coalesce("since", stamp).alias("first_seen"), stamp.alias("last_seen")))
