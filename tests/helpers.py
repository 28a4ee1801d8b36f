"""Rows and services for the tests."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from stratum.config import Lake
from stratum.schemas import BRONZE
from stratum.sources.state import State

T0 = dt.datetime(2024, 7, 1)


def post(id: str | None, caption: str | None = "text", timestamp: str | None = "2024-01-01T00:00:00.000Z", owner: str = "12345", user: str = "user1", **more) -> dict:
    return {"id": id, "shortCode": f"sc{id}", "caption": caption, "timestamp": timestamp, "ownerId": owner, "ownerUsername": user, "likesCount": 10, "commentsCount": 2, "hashtags": [], **more}


def bronze(spark: SparkSession, lake: Lake, dataset: str, rows: list[dict], schema=BRONZE) -> None:
    spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema).coalesce(1).write.mode("overwrite").parquet(f"{lake.bronze}/{dataset}.parquet")


def by_id(df: DataFrame, key: str = "post_id") -> dict:
    return {r[key]: r for r in df.collect()}


GOOD = {
    "admirality": "B1", "domain": "Business", "educational_json": {"summary": "teaches", "workflow": []}, "actionable_json": {"summary": "does", "tools": []},
}


class Fake:
    """Answers with a good document, unless the caption asks for trouble."""

    def __init__(self, log: str | None = None):
        self.log, self.calls = log, {}

    def analyze(self, prompt: str) -> str:
        caption = prompt.rsplit("Post:\n", 1)[1]
        n = self.calls[caption] = self.calls.get(caption, 0) + 1
        if self.log:
            with open(self.log, "a") as f:
                f.write(caption + "\n")
        if caption.startswith("always fails"):
            raise RuntimeError("service down")
        if caption.startswith("not json"):
            return "not json"
        if caption.startswith("fails once") and n == 1:
            raise RuntimeError("429")
        return json.dumps(GOOD)


def lake_and_state(spark: SparkSession, folder) -> tuple[Lake, State]:
    lake = Lake.at(f"file://{folder}")
    return lake, State(spark, lake.state)


def fetch_dataset(dataset_id: str):
    """What a service would send for a dataset."""
    for i in range(2):
        yield json.dumps({"id": f"{dataset_id}-{i}", "likesCount": i if i else "many", "hashtags": ["a"], "nested": {"x": 1}})
