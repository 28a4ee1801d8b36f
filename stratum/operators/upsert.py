"""Keyed upserts as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the source, and those of the target whose key it doesn't have.

    Columns are bound by name.  The source must hold a key once.
    """
    return target.join(source, list(keys), "left_anti").unionByName(source.select(*target.columns))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are held more than once, or are null in part, with their number of rows."""
    missing = F.lit(False)
    for key in keys:
        missing |= F.col(key).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where((F.col("n_rows") > 1) | missing)


def progress(won: DataFrame, datasets: DataFrame) -> DataFrame:
    """(source_dataset, post_count): rows that each of the datasets has won, 0 for those without."""
    return progress_of(won.groupBy("source_dataset").agg(F.count("*").alias("n_rows")), datasets)


def progress_of(counts: DataFrame, datasets: DataFrame) -> DataFrame:
    """The same of rows that are counted already, as (source_dataset, n_rows)."""
    known = counts.select("source_dataset", F.col("n_rows").cast("int").alias("post_count"))
    return datasets.select("source_dataset").distinct().join(known, "source_dataset", "left").select("source_dataset", F.coalesce("post_count", F.lit(0)).alias("post_count"))
