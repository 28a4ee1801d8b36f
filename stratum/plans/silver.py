"""Silver step: new bronze datasets into the table of posts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Lake
from ..operators.dedup import diagonal_union, latest_posts
from ..operators.normalize import normalize_all, stamp
from ..operators.upsert import progress_of
from ..schemas import DEFAULTS, SILVER
from ..sources.bronze import FILE, scan_files
from ..sources.catalog import QUARANTINE, keep_back, pending_files, refresh, short_datasets
from ..sources.files import delete
from ..sources.state import State

MARK = "silver_ig"
_DATASET = f"{FILE}_dataset"


def newest_first(posts: DataFrame) -> DataFrame:
    return posts.orderBy(F.desc_nulls_last("timestamp"), "post_id")


def merge_posts(state: State, rows: DataFrame, run_ts: dt.datetime) -> None:
    """Merge rows of the silver schema into the posts; new ones are stamped, and nulls where there must be none get the default."""
    rows = rows.withColumns({c: F.coalesce(c, F.lit(default)) for c, default in DEFAULTS["silver_ig_posts"].items()})
    state.guarded("silver_ig_posts").merge(rows, lambda old, new: stamp(latest_posts(diagonal_union([old, new], SILVER)), F.lit(run_ts)))


def record_progress(state: State, datasets: DataFrame, run_ts: dt.datetime) -> None:
    """Set the progress of the datasets (source_dataset) to the posts that they have won, by the counts of the last commit."""
    done = progress_of(state.table("silver_ig_posts").counts(), datasets).withColumn("completed_at", F.lit(run_ts).cast("timestamp_ntz"))
    state.table("silver_ig_progress").upsert(done)


def run_silver(lake: Lake, state: State, run_ts: dt.datetime) -> DataFrame:
    """Merge the datasets that changed since the mark, and those kept back before, and return all posts.

    Only buckets of posts in these datasets are written to.  What is read is
    staged once and its rows are counted by file; a dataset that comes short of
    its footers is kept back as a whole, and tried again by the next run.

    Posts, progress, quarantine and mark are one transaction, so a run that dies
    changes none of them.  The mark is the newest modification among the
    datasets seen: a dataset that arrives during the run is left for the next.
    """
    spark, posts = state.spark, state.table("silver_ig_posts")
    mark = state.mark(MARK)
    after = None if mark is None else int(mark.replace(tzinfo=dt.UTC).timestamp() * 1000)
    quarantined = state.table(QUARANTINE).read()
    files = pending_files(refresh(state, lake.bronze), quarantined, after)
    newest = files.agg(F.max("modified_ms")).first()[0]
    if newest is not None:
        scanned, staging = scan_files(spark, files, with_files=True), f"{state.root}/_staging/silver"
        reasons: dict[str, tuple] = {d: (reason, None, None) for d, reason in scanned.damaged.items()}
        with state.transaction():
            if scanned.frames:
                frames = [normalize_all(f, F.col(_DATASET), (FILE, _DATASET)) for f in scanned.frames]
                diagonal_union(frames).write.mode("overwrite").parquet(staging)
                staged = spark.read.schema(diagonal_union(frames).schema).parquet(staging)
                taken = files.where(F.col("dataset_id").isin(scanned.read))
                short = short_datasets(staged, taken).collect()  # a row for each damaged dataset
                reasons |= {r.dataset_id: (f"{r.path}: rows are missing", r.n_expected, r.n_found) for r in short}
                whole = staged.where(~F.col(_DATASET).isin([r.dataset_id for r in short])) if short else staged
                merge_posts(state, whole.where("post_id IS NOT NULL").select(*SILVER.names), run_ts)
            record_progress(state, files.select(F.col("dataset_id").alias("source_dataset")).distinct(), run_ts)
            keep_back(state, reasons, [*scanned.read, *scanned.idless], run_ts)
            if after is None or newest > after:
                state.advance(MARK, dt.datetime.fromtimestamp(newest / 1000, dt.UTC).replace(tzinfo=None))
        delete(spark, staging)
    return newest_first(posts.read())
