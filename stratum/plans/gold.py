"""Gold step: pending posts through the analyzer."""

from __future__ import annotations

import datetime as dt
import hashlib
import time
import uuid
from collections import deque
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EnrichConfig
from ..functions import is_blank
from ..operators import enrich
from ..sources.files import delete
from ..sources.state import State

MARK = "gold_ig"
#: Rows for each task of a run's first round, before it is known what the quota allows.
ROUND_ROWS = 1000
_PLACE = "__place"


def config_hash(model: str) -> str:
    """Digest of prompt and model, the same in every process."""
    return hashlib.sha256(f"{enrich.PROMPT}\n{model}".encode()).hexdigest()


def _pending(state: State, config: EnrichConfig) -> DataFrame:
    """Posts to analyze.  Unless `compat`, those that have an answer or a dead letter since are left out."""
    posts = state.table("silver_ig_posts").read()
    todo = enrich.pending(posts, state.table("watermarks").read(), MARK, post_ids=config.post_ids)
    if config.compat or config.post_ids:
        return todo
    answered = state.table("gold_ig_analyses").read().select("post_id", F.col("analysed_at").alias("at"))
    buried = state.table("dead_letter").read().select("post_id", F.col("failed_at").alias("at"))
    handled = answered.unionByName(buried).groupBy("post_id").agg(F.max("at").alias("at"))
    return enrich.unhandled(todo, handled)


def _completed(state: State, config: EnrichConfig) -> dt.datetime | None:
    """Timestamp up to which no post is pending."""
    first = _pending(state, config).agg(F.min("processed_on")).first()[0]
    posts = state.table("silver_ig_posts").read()
    done = posts if first is None else posts.where(F.col("processed_on") < F.lit(first))
    return done.agg(F.max("processed_on")).first()[0]


class _Waiting:
    """Rows that wait for the service, oldest first: written once, and read by the ranges that rounds take."""

    def __init__(self, rows: DataFrame, path: str):
        order = ("processed_on", "post_id")
        # A place has the partition above bit 33 and the row in it below.
        placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(_PLACE, F.monotonically_increasing_id())
        placed.write.parquet(path)
        self.rows = rows.sparkSession.read.schema(placed.schema).parquet(path)
        sizes = self.rows.groupBy(F.shiftright(_PLACE, 33).alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # a row for each partition
        self.ranges = deque((r.part << 33, (r.part << 33) + r.n) for r in sizes)

    def take(self, n: int) -> DataFrame:
        """The next n rows, or all that are left; the filter on their places leaves out the other files and pages."""
        first = last = self.ranges[0][0]
        while n and self.ranges:
            start, end = self.ranges.popleft()
            last = min(start + n, end)
            n -= last - start
            if last < end:
                self.ranges.appendleft((last, end))
        return self.rows.where((F.col(_PLACE) >= first) & (F.col(_PLACE) < last)).drop(_PLACE)


def _analyze(todo: DataFrame, make_analyzer: Callable[[], enrich.Analyzer], config: EnrichConfig, folder: str, sleep: Callable[[float], None]) -> tuple[DataFrame, bool]:
    """Answers of the rows that were tried, and whether rows were left untried.

    Rows go to the service in rounds.  A round ends early where the quota does:
    each task stops at the first answer that asks for more than a short wait, so
    a quota costs a call of each task.  The driver then waits once for all, and
    the next round tries rows that the ones before left.  After the last pause,
    or a round in which no row was tried, the others are left.

    A round reads twice as many rows as the one before has tried, so that what
    all rounds read grows with the rows and not with rows times rounds.
    """
    spark, answers = todo.sparkSession, f"{folder}/answers"
    waiting = [_Waiting(todo.where(~is_blank(F.col("caption"))), f"{folder}/waiting-0")]
    size, rounds, paused, left = ROUND_ROWS * config.parallelism, 0, 0, False
    while waiting and not left:
        if not waiting[-1].ranges:
            waiting.pop()
            continue
        rows, rounds = waiting[-1].take(size), rounds + 1
        path = f"{answers}/round={rounds}"
        enrich.analyze(rows, make_analyzer, config.attempts, config.backoff_seconds, config.parallelism, max(config.quota_pauses - paused, 0), config.quota_task_wait).write.parquet(path)
        got = spark.read.schema(enrich.ANALYZED).parquet(path)
        told = got.agg(F.count_if(F.col("ok").isNull()).alias("untried"), F.count("ok").alias("tried"), F.max("retry_after").alias("wait"), F.coalesce(F.max("pauses"), F.lit(0)).alias("pauses")).first()
        paused, size = paused + told.pauses, 2 * max(told.tried, 1)
        if told.untried:
            left = not told.tried or paused >= config.quota_pauses
            if not left:
                waiting.append(_Waiting(rows.join(got.where("ok IS NULL").select("post_id"), "post_id", "left_semi"), f"{folder}/waiting-{rounds}"))
                sleep(min(config.quota_wait if told.wait is None else told.wait, config.quota_wait_max))
                paused += 1
    if not rounds:
        return spark.createDataFrame([], enrich.ANALYZED), False
    return spark.read.schema(f"{enrich.ANALYZED}, round int").parquet(answers).where("ok IS NOT NULL").drop("round"), left


def run_gold(
    state: State, make_analyzer: Callable[[], enrich.Analyzer], run_ts: dt.datetime, config: EnrichConfig | None = None, model: str = "default", sleep: Callable[[float], None] = time.sleep
) -> DataFrame:
    """Analyze pending posts, and return all analyses.

    The answers are written once before they are routed, so no row is sent
    twice.  Analyses, dead letters and the mark are one transaction: after a
    crash none of them has changed.  Posts that a quota kept from being tried
    get neither, and the mark stays before them, with `compat`, too.
    """
    config = config or EnrichConfig()
    spark = state.spark
    todo = enrich.batch(_pending(state, config), config.batch_limit, "processed_on", "post_id")
    staging = f"{state.root}/_staging/{uuid.uuid4().hex}"
    todo.select("post_id", "caption", "processed_on").write.parquet(f"{staging}/todo")
    todo = spark.read.parquet(f"{staging}/todo")
    if not todo.isEmpty():
        stamp = F.lit(run_ts)
        analyzed, untried = _analyze(todo, make_analyzer, config, f"{staging}/analyzed", sleep)
        with state.transaction():
            state.guarded("gold_ig_analyses").upsert(enrich.analyses(analyzed, stamp))
            letters = state.guarded("dead_letter")
            new = enrich.skipped_letters(todo, stamp).unionByName(enrich.failed_letters(analyzed, stamp))
            letters.upsert(enrich.add_attempts(new, letters.read()))
            if not config.post_ids:
                mark = run_ts if config.compat and not untried else _completed(state, replace(config, compat=False))
                if mark is not None:
                    state.advance(MARK, mark, config_hash(model))
    delete(spark, staging)
    return state.table("gold_ig_analyses").read()
