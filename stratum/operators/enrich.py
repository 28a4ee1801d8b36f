"""Enrichment of posts by an external analyzer, with retries and dead letters."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_blank
from ..schemas import ANALYSIS_VERSION

DOMAIN = "instagram"
EPOCH = "1970-01-01 00:00:00"
#: What an analyzer is asked, before the caption; the names of the JSON fields in it are fixed values.
PROMPT = (
    "Classify the post below and answer with one JSON object. Give is_educational and is_actionable (booleans), admirality (a code from A1 to C2), "
    "domain, subdomain, topic, subtopic, content_type, style and format; educational_json with summary, workflow, concepts, principles and techniques "
    "if the post teaches something; actionable_json with summary, resources, tools, guides and downloads if one can act on it.\n\nPost:\n"
)
ANALYZED = "post_id string, ok boolean, result_json string, error string, attempts int, retry_after double, pauses int"


class QuotaExceeded(RuntimeError):
    """Raised by an analyzer whose service takes no more calls for now, with the seconds to wait if the service tells them."""

    def __init__(self, message: str = "quota exceeded", retry_after: float | None = None):
        super().__init__(message)
        self.retry_after = retry_after


class Analyzer(Protocol):
    """Answers a prompt with JSON text, or raises: QuotaExceeded if it may be asked again later."""

    def analyze(self, prompt: str) -> str: ...


def high_water(marks: DataFrame, name: str) -> DataFrame:
    """One row: the timestamp of a named mark, the epoch if there is none."""
    found = F.max(F.when(F.col("name") == name, F.col("timestamp")))
    return marks.agg(F.coalesce(found, F.lit(EPOCH).cast("timestamp_ntz")).alias("mark"))


def pending(posts: DataFrame, marks: DataFrame, name: str = "gold_ig", column: str = "processed_on", post_ids: Sequence[str] = ()) -> DataFrame:
    """Posts that were processed after the mark; with ids, those posts whatever the mark.

    The mark, one value, is read first, so that the filter reaches the scan.
    """
    if post_ids:
        wanted = posts.sparkSession.createDataFrame([(i,) for i in sorted(set(post_ids))], "post_id string")
        return posts.join(wanted, "post_id", "left_semi")
    return posts.where(F.col(column) > F.lit(high_water(marks, name).first().mark).cast("timestamp_ntz"))


def unhandled(posts: DataFrame, handled: DataFrame) -> DataFrame:
    """Posts without an entry in (post_id, at) that is as new as their processing."""
    h = handled.select(F.col("post_id").alias("__id"), F.col("at").alias("__at"))
    return posts.join(h, (F.col("post_id") == F.col("__id")) & (F.col("__at") >= F.col("processed_on")), "left_anti")


def batch(df: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """The first rows in an order, nulls last; all of them without a limit."""
    return df if limit is None else df.orderBy(*(F.asc_nulls_last(c) for c in order)).limit(limit)


def skipped_letters(posts: DataFrame, run_ts: Column) -> DataFrame:
    """Dead letters of the posts with blank captions."""
    return posts.where(is_blank(F.col("caption"))).select(
        "post_id", F.lit(DOMAIN).alias("domain"), F.lit("Empty caption").alias("error"), F.lit(0).alias("attempts"), run_ts.cast("timestamp_ntz").alias("failed_at"), F.lit("skipped").alias("status")
    )


def analyze_once(analyzer: Analyzer, caption: str, attempts: int, backoff: float, sleep: Callable[[float], None] = time.sleep) -> tuple[bool, str | None, str | None, int]:
    """(ok, JSON text, error, attempts): tries until an answer is JSON, waiting backoff ** attempt seconds between.

    A quota is no failure of the row, and is raised on.
    """
    error = None
    for attempt in range(1, attempts + 1):
        try:
            text = analyzer.analyze(PROMPT + caption)
            json.loads(text)
            return True, text, None, attempt
        except QuotaExceeded:
            raise
        except Exception as problem:  # noqa: BLE001  whatever the service raises counts as a failed attempt
            error = str(problem) or type(problem).__name__
        if attempt < attempts:
            sleep(backoff**attempt)
    return False, None, error, attempts


def analyze(posts: DataFrame, make_analyzer: Callable[[], Analyzer], attempts: int = 3, backoff: float = 2.0, parallelism: int = 4, pauses: int = 0, task_wait: float = 0.0) -> DataFrame:
    """(post_id, ok, result_json, error, attempts, retry_after, pauses) of posts with a caption.

    At most `parallelism` rows are with the service at a time, and a task
    builds one analyzer.  Where a quota answer asks for `task_wait` seconds at
    most, the task waits and goes on with a new analyzer, up to `pauses` times
    and as long as each pause brings an answer; `pauses` of a row are those of
    its task before it.  After another quota answer it calls no more: its other
    rows come back untried, with no `ok`, no attempts, and what the quota said.
    Write the result before it is read twice: each evaluation calls the service
    again.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        analyzer, quota, paused, answered = make_analyzer(), None, 0, False
        for frame in frames:
            rows = []
            for post_id, caption in zip(frame["post_id"], frame["caption"], strict=True):
                while quota is None:
                    try:
                        rows.append((post_id, *analyze_once(analyzer, caption, attempts, backoff), None, paused))
                        answered = True
                        break
                    except QuotaExceeded as problem:
                        wait = problem.retry_after
                        if not answered or paused >= pauses or wait is None or wait > task_wait:
                            quota = problem
                        else:
                            time.sleep(max(wait, 0.0))
                            analyzer, paused, answered = make_analyzer(), paused + 1, False
                else:
                    rows.append((post_id, None, None, str(quota), 0, quota.retry_after, paused))
            yield pd.DataFrame(rows, columns=["post_id", "ok", "result_json", "error", "attempts", "retry_after", "pauses"])

    captions = posts.where(~is_blank(F.col("caption"))).select("post_id", "caption")
    return captions.repartition(parallelism).mapInPandas(run, ANALYZED)


def analyses(analyzed: DataFrame, run_ts: Column) -> DataFrame:
    """Gold rows of the successes."""
    return analyzed.where("ok").select("post_id", F.lit(ANALYSIS_VERSION).alias("schema_version"), "result_json", run_ts.cast("timestamp_ntz").alias("analysed_at"))


def failed_letters(analyzed: DataFrame, run_ts: Column) -> DataFrame:
    """Dead letters of the failures."""
    return analyzed.where("NOT ok").select("post_id", F.lit(DOMAIN).alias("domain"), "error", "attempts", run_ts.cast("timestamp_ntz").alias("failed_at"), F.lit("pending").alias("status"))


def add_attempts(letters: DataFrame, known: DataFrame) -> DataFrame:
    """New dead letters, with the attempts of the old ones of the same key added."""
    old = known.select("post_id", "domain", F.col("attempts").alias("__before"))
    joined = letters.join(old, ["post_id", "domain"], "left")
    return joined.withColumn("attempts", F.col("attempts") + F.coalesce("__before", F.lit(0))).select(*letters.columns)
