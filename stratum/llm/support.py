"""Session helpers shared by the operators: scratch tables and components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from ..sources.files import file_system

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of two or three numbers that may be broadcast (some 30 MB).
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """A table of numbers with a broadcast hint, if a count of its rows allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


#: Arrow batches that go to Python tasks: at most these bytes, or one row.
BATCH_BYTES = 6 << 20
#: The same where rows are packed and grouped before: small batches take Spark more memory there.
GROUP_BATCH_BYTES = 64 << 20
#: Bytes of a Parquet row group of wide rows.  Spark decodes 4,096 rows of a row group at once, whatever their size.
WIDE_GROUP_BYTES = 8 << 20


def bound_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """Bound the bytes of Arrow batches in this session, so that long texts don't fill a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))


class Scratch:
    """Intermediate tables as Parquet in the shared folder.

    They cut lineage in a way that a lost executor can't undo.  `drop` frees
    the disk of a table that no later step reads; results are lazy, so what
    they read stays until the application ends, and goes then.  `wide` names
    the tables whose rows have many kilobytes: what a task holds to write or
    read these is bounded by bytes.
    """

    def __init__(self, spark: SparkSession, name: str, wide: tuple[str, ...] = ()):
        self.spark, self.wide = spark, wide
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        fs, path = file_system(spark, self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def _write(self, df: DataFrame, path: str, by: str | None = None) -> None:
        """Append a table; the shuffle files that it took go at once."""
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            writer = df.write.mode("append").option("compression", "zstd")
            if path.rpartition("/")[2].partition("-")[2] in self.wide:  # sizes are looked at after each row, not first after a hundred
                writer = writer.option("parquet.block.size", WIDE_GROUP_BYTES).option("parquet.page.size.row.check.min", 1)
            (writer.partitionBy(by) if by else writer).parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, before)

    def keep(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write a table, in a folder for each value of column `by` if one is given, and read it again."""
        path = self.path(name)
        self._write(df, path, by)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._scratch_path = path
        return kept

    def add(self, df: DataFrame, table: DataFrame) -> DataFrame:
        """A kept table with further rows."""
        self._write(df, table._scratch_path)
        more = self.spark.read.schema(table.schema).parquet(table._scratch_path)
        more._scratch_path = table._scratch_path
        return more

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            fs, path = file_system(self.spark, table._scratch_path)
            fs.delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only (`lower` also maps letters beyond ASCII)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label): the smallest node reachable over undirected edges (a, b).

    Every round hooks each node to its smallest neighbour and contracts the
    graph to the hooks, so that the edges shrink by a constant factor at
    least; nodes, edges and labels stay distributed.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    graph = scratch.keep(both.union(both.select("v", "u")).distinct(), "graph")
    labels: DataFrame | None = None
    while not graph.isEmpty():
        hooks = scratch.keep(graph.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")), "hooks")
        if labels is None:
            labels = hooks.select(F.col("u").alias("node"), F.col("p").alias("label"))
        else:
            moved = labels.join(hooks, F.col("label") == F.col("u"), "left").select("node", F.coalesce("p", "label").alias("label"))
            labels = scratch.keep(moved, "labels")
        left = graph.join(hooks, "u").select("v", F.col("p").alias("pu"))
        joined = left.join(hooks.select(F.col("u").alias("v"), F.col("p").alias("pv")), "v")
        graph = scratch.keep(joined.where("pu <> pv").select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct(), "graph")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0)
    return labels


def crc32_mod(id_col: str, modulus: int) -> Column:
    """crc32 of an id written as decimal text, modulo `modulus`; null for a null id."""
    return F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % modulus
