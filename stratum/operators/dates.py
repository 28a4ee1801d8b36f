"""Date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_dimension(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """A row for each day from first to last, both included; none if last is before first."""
    days = max(0, (last - first).days + 1)
    date = F.date_add(F.lit(first), F.col("id").cast("int"))
    out = spark.range(days).select(date.alias("date"))
    weekday = F.weekday("date") + 1  # Monday is 1
    return out.select(
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        weekday.alias("day_of_week"),
        F.weekofyear("date").alias("week"),
        (weekday >= 6).alias("is_weekend"),
    )
