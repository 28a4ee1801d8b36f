"""NDJSON files and folders of JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_ndjson(spark: SparkSession, path: str, schema: T.StructType | None = None, sampling_ratio: float = 1.0) -> DataFrame:
    """Rows of NDJSON; without a schema it is inferred from all lines or a share of them.

    Lines that are no JSON give rows of nulls.
    """
    reader = spark.read.option("samplingRatio", str(sampling_ratio)).option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def scan_strict(spark: SparkSession, path: str) -> DataFrame:
    """Rows of NDJSON with a schema inferred from all lines; any line that is no JSON raises when the schema is inferred."""
    return spark.read.option("mode", "FAILFAST").json(path)


def scan_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(stem, folder, fields of the schema) of files with one JSON document each; malformed files are left out."""
    wanted = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    df = spark.read.schema(wanted).option("multiLine", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    parts = F.split(F.col("_metadata.file_path"), "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.json$", "")
    return df.select(F.url_decode(stem).alias("stem"), F.url_decode(F.element_at(parts, -2)).alias("folder"), *schema.names, "_corrupt").where("_corrupt IS NULL").drop("_corrupt")
