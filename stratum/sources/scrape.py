"""Ingest of scraped datasets into bronze."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from ..config import ScrapeConfig
from ..operators.normalize import fit_schema
from ..schemas import BRONZE
from .files import delete, read_text, write_text, written
from .ndjson import scan_ndjson


@dataclass(frozen=True)
class Run:
    run_id: str
    actor: str


class ScrapeSource(Protocol):
    """A service that scrapes on demand.  Failures and timeouts raise RuntimeError."""

    def trigger(self, config: ScrapeConfig, token: str) -> Run: ...

    def wait(self, run: Run, token: str) -> str:
        """Id of the run's dataset."""
        ...

    def download(self, dataset_id: str, dest: str, token: str) -> int:
        """Write the dataset as NDJSON to a path that Spark can read; number of items."""
        ...


def read_meta(spark: SparkSession, path: str) -> dict | None:
    """Sidecar of a dataset; None if it is missing or no JSON object."""
    text = read_text(spark, f"{path}.meta")
    try:
        meta = json.loads(text) if text is not None else None
    except ValueError:
        return None
    return meta if isinstance(meta, dict) else None


def ingest(spark: SparkSession, source: ScrapeSource, config: ScrapeConfig, bronze: str, token: str, now: dt.datetime | None = None) -> DataFrame:
    """Run a scrape and keep its dataset as `<id>.parquet` with a sidecar `.meta`.

    A dataset that is there as a whole is read and not downloaded again; one
    that a writer left half-written is replaced, and a missing sidecar is
    written from the dataset.  A dataset without items becomes one without rows
    and with the bronze columns.
    """
    if not token:
        raise RuntimeError("the token of the scrape service is not set")
    run = source.trigger(config, token)
    dataset_id = source.wait(run, token)
    path = f"{bronze.rstrip('/')}/{dataset_id}.parquet"
    count = None
    if not written(spark, path):
        raw = f"{bronze.rstrip('/')}/{dataset_id}.jsonl"
        count = source.download(dataset_id, raw, token)
        df = scan_ndjson(spark, raw) if count else None
        if df is None or not df.columns:
            df = fit_schema(spark.createDataFrame([], BRONZE), BRONZE)
        df.write.mode("overwrite").parquet(path)
        delete(spark, raw)
    if count is not None or read_meta(spark, path) is None:
        stamp = (now or dt.datetime.now(dt.UTC)).isoformat()
        count = spark.read.parquet(path).count() if count is None else count
        write_text(spark, f"{path}.meta", json.dumps({"run_id": run.run_id, "actor": run.actor, "item_count": count, "downloaded_at": stamp}))
    return spark.read.parquet(path)
