"""From bronze columns, as they come, to the silver schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lenient_timestamp, list_to_json, post_url
from ..schemas import BRONZE_TO_SILVER, SILVER, SILVER_DEFAULTS


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def rename_columns(df: DataFrame, names: Mapping[str, str] = BRONZE_TO_SILVER) -> DataFrame:
    """Rename the columns that are there, unless the new name is taken."""
    have = set(df.columns)
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in have and new not in have})


def add_defaults(df: DataFrame, defaults: Mapping[str, object] = SILVER_DEFAULTS, schema: T.StructType = SILVER) -> DataFrame:
    """Add the columns that are missing, with their default in the schema's type."""
    missing = {c: F.lit(v).cast(schema[c].dataType) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def fit_column(df: DataFrame, field: T.StructField) -> Column:
    """A column in a field's type: null if it is absent or a value can't be cast, JSON text for nested values."""
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    actual, column = df.schema[field.name].dataType, _quoted(field.name)
    if actual == field.dataType:
        return column
    if isinstance(field.dataType, T.StringType) and isinstance(actual, T.ArrayType | T.StructType | T.MapType):
        return list_to_json(column).alias(field.name)
    if isinstance(field.dataType, T.TimestampNTZType) and isinstance(actual, T.StringType):
        return lenient_timestamp(column).alias(field.name)
    if isinstance(actual, T.ArrayType | T.StructType | T.MapType | T.BinaryType) or isinstance(actual, T.BooleanType) and isinstance(field.dataType, T.TimestampNTZType):
        return F.lit(None).cast(field.dataType).alias(field.name)
    return column.try_cast(field.dataType).alias(field.name)


def fit_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of a schema, in its order and types."""
    return df.select(*(fit_column(df, f) for f in schema.fields))


def stamp(df: DataFrame, run_ts: Column, column: str = "processed_on") -> DataFrame:
    """Set a timestamp where it is null."""
    return df.withColumn(column, F.coalesce(F.col(column), run_ts.cast("timestamp_ntz")))


def normalize_all(df: DataFrame, dataset: Column, carry: tuple[str, ...] = ()) -> DataFrame:
    """Bronze rows in the silver schema, also those without a post id, and further columns as they are.

    `dataset` names the dataset a row is from, where the row itself doesn't or has null.
    """
    df = rename_columns(df)
    if "source_dataset" not in df.columns:
        df = df.withColumn("source_dataset", dataset)
    elif isinstance(df.schema["source_dataset"].dataType, T.StringType):
        df = df.withColumn("source_dataset", F.coalesce("source_dataset", dataset))
    df = add_defaults(df)
    df = df.select(*(fit_column(df, f) for f in SILVER.fields), *carry)
    return df.withColumns({"url": post_url(F.col("url"), F.col("shortcode")), "hashtags": F.coalesce("hashtags", F.lit("[]"))})


def normalize(df: DataFrame, dataset: Column) -> DataFrame:
    """The same without rows that have no post id."""
    return normalize_all(df, dataset).where(F.col("post_id").isNotNull())
