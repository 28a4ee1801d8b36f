"""Scraped datasets as a Spark source: tasks download them, one dataset for each partition.

    spark.dataSource.register(DatasetFeed)
    spark.read.format("dataset_feed").schema("id string").option("ids", "ds_1,ds_2").option("fetch", "package.module:function").load()

`function(dataset_id)` yields lines of JSON and must be importable by the
executors.  A download that fails is retried with its task.  With the option
`raw` the lines are given as they are, in a single column.  `FeedDownload`
lets `scrape.ingest` download in that way.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructType

from ..config import ScrapeConfig
from .scrape import Run, ScrapeSource


class _Dataset(InputPartition):
    def __init__(self, id: str):
        super().__init__(id)
        self.id = id


def fit_value(value: object, kind: object) -> object:
    """A JSON value in a column's type; null where it doesn't fit, JSON text for nested values in text columns."""
    if value is None:
        return None
    if isinstance(kind, StringType):
        return value if isinstance(value, str) else json.dumps(value)
    if isinstance(kind, BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(kind, IntegerType | LongType):
        return value if isinstance(value, int) and not isinstance(value, bool) else None
    if isinstance(kind, DoubleType):
        return float(value) if isinstance(value, int | float) and not isinstance(value, bool) else None
    if isinstance(kind, ArrayType):
        return [fit_value(x, kind.elementType) for x in value] if isinstance(value, list) else None
    return None


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.fields = [(f.name, f.dataType) for f in schema.fields]
        self.ids = [i for i in options.get("ids", "").split(",") if i]
        self.fetch = options["fetch"]
        self.raw = options.get("raw", "false").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        return [_Dataset(i) for i in self.ids] or [_Dataset("")]

    def read(self, partition: _Dataset) -> Iterator[tuple]:
        module, _, name = self.fetch.partition(":")
        fetch = getattr(importlib.import_module(module), name)
        for line in fetch(partition.id) if partition.id else ():
            if self.raw:
                yield (line.rstrip("\n"),)
                continue
            row = json.loads(line)
            yield tuple(fit_value(row.get(n), kind) for n, kind in self.fields)


class DatasetFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dataset_feed"

    def schema(self) -> str:
        raise ValueError("dataset_feed needs a schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, dict(self.options))


@dataclass(frozen=True)
class FeedDownload:
    """A scrape source whose datasets are downloaded by a task, and not by the driver."""

    spark: SparkSession
    source: ScrapeSource
    fetch: str

    def trigger(self, config: ScrapeConfig, token: str) -> Run:
        return self.source.trigger(config, token)

    def wait(self, run: Run, token: str) -> str:
        return self.source.wait(run, token)

    def download(self, dataset_id: str, dest: str, token: str) -> int:
        """The function behind `fetch` has its token from the executors' environment."""
        self.spark.dataSource.register(DatasetFeed)
        lines = self.spark.read.format(DatasetFeed.name()).schema("value string").option("ids", dataset_id).option("fetch", self.fetch).option("raw", "true").load()
        lines.write.mode("overwrite").text(dest)
        return self.spark.read.text(dest).count()
