"""Type-2 slowly changing dimension of profiles, as set operations."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import DIM_PROFILE
from ..session import shared_folder
from ..sources.files import delete_on_exit
from .upsert import upsert

CHANNEL = "instagram"


def observed_names(posts: DataFrame) -> DataFrame:
    """(owner_id, owner_username, last_seen): each name of each known owner."""
    return posts.where(F.col("owner_id").isNotNull()).groupBy("owner_id", "owner_username").agg(F.max("timestamp").alias("last_seen"))


def max_key(dim: DataFrame) -> DataFrame:
    """One row: the largest key, 0 for an empty dimension."""
    return dim.agg(F.coalesce(F.max("profile_key"), F.lit(0)).alias("max_key"))


def name_changes(dim: DataFrame, observed: DataFrame) -> DataFrame:
    """(owner_id, owner_username, seq, is_last): the names to open, in order, for each owner whose newest name is new.

    An owner whose newest name is the current one is left alone, so a second
    run over the same posts changes nothing.
    """
    current = dim.where("is_current").select("owner_id", F.col("owner_username").alias("current_name"), F.lit(True).alias("known"))
    by_time = Window.partitionBy("owner_id").orderBy(F.asc_nulls_first("last_seen"), F.asc_nulls_first("owner_username"))
    whole = Window.partitionBy("owner_id").orderBy(F.asc_nulls_first("last_seen"), F.asc_nulls_first("owner_username")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordered = observed.join(current, "owner_id", "left").withColumns(
        {
            "seq": F.row_number().over(by_time),
            "newest": F.last(F.struct("owner_username")).over(whole)["owner_username"],
            # The name before: that of the observation before, for the first one the current name.
            "before": F.coalesce(F.lag(F.struct("owner_username", F.lit(True).alias("known"))).over(by_time), F.when(F.col("known"), F.struct(F.col("current_name").alias("owner_username"), "known"))),
        }
    )
    settled = F.coalesce(F.col("known"), F.lit(False)) & F.col("newest").eqNullSafe(F.col("current_name"))
    changed = F.col("before").isNull() | ~F.col("owner_username").eqNullSafe(F.col("before.owner_username"))
    kept = ordered.where(~settled & changed)
    return kept.select("owner_id", "owner_username", "seq", (F.row_number().over(Window.partitionBy("owner_id").orderBy(F.desc("seq"))) == 1).alias("is_last"))


def changed_rows(dim: DataFrame, observed: DataFrame, run_ts: Column, first_key: int | None = None) -> DataFrame:
    """The rows of the dimension that a run closes, and those that it opens.

    Of several new names of an owner only the last stays open.  New keys
    follow `first_key` (by default the largest key) in order of owner and time.
    They are dealt by a prefix sum over ranges of owners and times, so that no
    task sees all changes.
    """
    run_ts = run_ts.cast("timestamp_ntz")
    opened = dense_numbers(name_changes(dim, observed), "owner_id", "seq")
    start = F.lit(first_key) if first_key is not None else F.col("max_key")
    columns = [f.name for f in DIM_PROFILE.fields]
    closed = dim.where("is_current").join(opened.select("owner_id").distinct(), "owner_id", "left_semi").withColumns({"effective_to": run_ts, "is_current": F.lit(False)})
    numbered = opened.join(F.broadcast(max_key(dim))) if first_key is None else opened  # one row
    new = numbered.select(
        (start + F.col("number")).cast("int").alias("profile_key"),
        "owner_id",
        "owner_username",
        F.lit(CHANNEL).alias("channel"),
        run_ts.alias("effective_from"),
        F.when(~F.col("is_last"), run_ts).alias("effective_to"),
        F.col("is_last").alias("is_current"),
    )
    return closed.select(*columns).unionByName(new.select(*columns))


def apply_names(dim: DataFrame, observed: DataFrame, run_ts: Column, first_key: int | None = None) -> DataFrame:
    """The dimension after a run: its rows, with those that the run changes replaced or added."""
    return upsert(dim.select(*(f.name for f in DIM_PROFILE.fields)), changed_rows(dim, observed, run_ts, first_key), ["profile_key"])


def dense_numbers(df: DataFrame, *order: str) -> DataFrame:
    """Rows numbered 1, 2, 3, ... in an order, without one task that sees them all.

    Ranges of all the columns of the order, as even as a sample makes them,
    are sorted and numbered by themselves; the sizes of the ranges before, of
    which there are as many as shuffle partitions, are added.  The ranges are
    written to the shared folder, since a second run would draw others.
    """
    spark = df.sparkSession
    keys = [F.asc_nulls_first(c) for c in order]
    # An id has the partition above bit 33 and the place in it below.
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id())
    path = f"{shared_folder(spark)}/numbers-{uuid.uuid4().hex}"
    delete_on_exit(spark, path)
    rows.write.mode("append").option("compression", "zstd").parquet(path)
    kept = spark.read.schema(rows.schema).parquet(path).withColumn("__range", F.shiftright("__id", 33))
    sizes = kept.groupBy("__range").agg(F.count("*").alias("__n"))
    before = sizes.select("__range", F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    number = F.col("__before") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return kept.join(F.broadcast(before), "__range").withColumn("number", number).drop("__range", "__id", "__before")
