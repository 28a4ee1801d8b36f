"""Unions of drifting frames, and the latest row of each key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .normalize import fit_column, fit_schema
from .supertypes import widened_union

_ROW = "__row_number"


def diagonal_union(frames: Sequence[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Rows of all frames by column name; columns that a frame lacks are null.

    With a schema every frame is cast to it, and values that don't fit are null
    (`unfit_values` counts them); without one, columns whose types drift apart
    get their common type.
    """
    if schema is None:
        return widened_union(frames)
    return reduce(DataFrame.unionAll, [fit_schema(f, schema) for f in frames])


def unfit_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: for each column of the schema, the values that turn null when they are cast to its type."""
    fitted = {f.name: fit_column(df, f) for f in schema.fields if f.name in df.columns}
    return df.agg(*((F.count_if(F.col(f"`{c}`").isNotNull() & v.isNull()) if (v := fitted.get(c)) is not None else F.lit(0).cast("long")).alias(c) for c in schema.names))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    One shuffle on the keys; the planner keeps one row of a key for each task
    before it, so a hot key is no hot spot.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_ROW, F.row_number().over(window)).where(F.col(_ROW) == 1).drop(_ROW)


def latest_posts(df: DataFrame) -> DataFrame:
    """The latest row of each post; then the last dataset by name, then the row that was there before."""
    order = (F.desc_nulls_last("timestamp"), F.desc_nulls_last("source_dataset"), F.asc_nulls_last("processed_on"))
    return latest_per_key(df, ["post_id"], order)
