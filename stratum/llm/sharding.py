"""Sharding by size-tiered compaction under a versioned manifest.

A store is a folder of immutable runs of Parquet files (shards) and of
manifest versions.  An arrival is appended as a run of small shards.  Runs of
a similar size are of one tier; when a tier has FANOUT runs, they are merged
into one run of target-sized shards, which belongs to a higher tier.  Runs
whose shards have that size already move by their manifest entry alone, so a
row is rewritten until its shard is large enough, and no more.  A run of many
shards far below the target (a bulk arrival has one for each write task) is
merged without waiting for its tier.  A merge reads whole runs and coalesces
their scan into target-sized tasks: no shuffle, and no key that could be hot.

A version of the manifest is a small JSON file that names the live runs (a few
for each tier, whatever the size of the data).  It is written aside and then
renamed to its number, which fails if the number is taken: of two writers one
commits, and the other reads the new version and tries again.  Readers see
whole versions only.  Data of runs that no version keeps goes with `vacuum`.
That needs a file system whose rename is atomic (HDFS, local disks); the store
refuses object stores, which copy instead.

DataFrame operations only.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import file_system, require_atomic_rename

#: Bytes of a shard after a merge, about.
TARGET_BYTES = 128 << 20
#: Runs of a tier that are merged, and the ratio of sizes between tiers.
FANOUT = 4
#: Runs up to this size are of the lowest tier.
SMALL_BYTES = 1 << 20


class CommitConflict(RuntimeError):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Run:
    """Shards in one or more folders."""

    paths: tuple[str, ...]
    rows: int
    bytes: int
    files: int

    def full(self, target_bytes: int) -> bool:
        """Whether the shards have more than half the target's size, on the mean."""
        return self.bytes > self.files * target_bytes / 2

    def __add__(self, other: Run) -> Run:
        return Run(self.paths + other.paths, self.rows + other.rows, self.bytes + other.bytes, self.files + other.files)

    def undersized(self, target_bytes: int) -> bool:
        """Whether the run has twice the shards that target-sized ones would be, or more."""
        return self.files >= 2 * max(1, math.ceil(self.bytes / target_bytes))

    @property
    def tier(self) -> int:
        return 0 if self.bytes <= SMALL_BYTES else 1 + int(math.log(self.bytes / SMALL_BYTES, FANOUT))


@dataclass(frozen=True)
class Manifest:
    version: int
    runs: tuple[Run, ...]


class ShardStore:
    """Rows of one schema in a folder that driver and executors share.

    Columns are bound by name: those that an arrival lacks are null, and
    others of it are ignored.  Nulls, empty and long texts, and repeated rows
    are kept as they are; an empty arrival adds no run.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, target_bytes: int = TARGET_BYTES):
        require_atomic_rename(root)
        self.spark, self.root, self.schema, self.target_bytes = spark, root.rstrip("/"), schema, target_bytes

    # -- manifest --

    def _version_path(self, version: int) -> str:
        return f"{self.root}/manifest/{version:012d}.json"

    def versions(self) -> list[int]:
        fs, path = file_system(self.spark, f"{self.root}/manifest")
        if not fs.exists(path):
            return []
        return sorted(int(n[:-5]) for s in fs.listStatus(path) if (n := s.getPath().getName()).endswith(".json") and n[0] != ".")

    def manifest(self, version: int | None = None) -> Manifest:
        """A version, the newest if none is named; version 0 is the empty store."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Manifest(0, ())
        fs, path = file_system(self.spark, self._version_path(version))
        stream = fs.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(version, tuple(Run(**r | {"paths": tuple(r["paths"])}) for r in json.loads(text)["runs"]))

    def commit(self, base: Manifest, runs: tuple[Run, ...]) -> Manifest:
        """Make `runs` the version after `base`, or raise CommitConflict."""
        new = Manifest(base.version + 1, runs)
        fs, aside = file_system(self.spark, f"{self.root}/manifest/.{uuid.uuid4().hex}")
        stream = fs.create(aside, False)
        stream.write(bytearray(json.dumps({"version": new.version, "runs": [asdict(r) for r in runs]}, indent=1).encode()))
        stream.close()
        jvm = self.spark.sparkContext._jvm
        _, final = file_system(self.spark, self._version_path(new.version))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        no_overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(aside, final, no_overwrite)
        except Py4JJavaError as error:
            fs.delete(aside, False)
            if fs.exists(final):
                raise CommitConflict(f"version {new.version} exists") from error
            raise
        return new

    def _update(self, change: Callable[[tuple[Run, ...]], tuple[Run, ...]]) -> Manifest:
        while True:
            base = self.manifest()
            try:
                return self.commit(base, change(base.runs))
            except CommitConflict:
                continue

    # -- data --

    def _bound(self, df: DataFrame) -> list[Column]:
        have = set(df.columns)
        return [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields]

    def _run(self, path: str, rows: int | None = None) -> Run:
        fs, folder = file_system(self.spark, path)
        sizes = [s.getLen() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".parquet")]
        return Run((path,), self._read((path,)).count() if rows is None else rows, sum(sizes), len(sizes))  # a count reads the footers

    def _read(self, paths: tuple[str, ...]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def append(self, df: DataFrame) -> Manifest:
        """Add an arrival as one run."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        df.select(*self._bound(df)).write.option("compression", "zstd").parquet(path)
        run = self._run(path)
        return self._update(lambda runs: (*runs, run) if run.rows else runs)

    def append_each(self, df: DataFrame, arrival: Column) -> Manifest:
        """Add the arrivals that a column tells apart as a run each, in one pass and one version."""
        staging, column = f"{self.root}/data/{uuid.uuid4().hex}", f"run_{uuid.uuid4().hex}"
        rows = df.select(*self._bound(df), F.coalesce(arrival.cast("long"), F.lit(-1)).alias(column))
        rows.write.partitionBy(column).option("compression", "zstd").parquet(staging)
        counts = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(column, T.LongType())])).parquet(staging).groupBy(column).count()
        counts = {f"{column}={r[0]}": r[1] for r in counts.toLocalIterator()}
        fs, folder = file_system(self.spark, staging)
        new = []
        for status in fs.listStatus(folder):
            if rows_of := counts.get(status.getPath().getName()):
                path = f"{self.root}/data/{uuid.uuid4().hex}"
                fs.rename(status.getPath(), file_system(self.spark, path)[1])
                new.append(self._run(path, rows_of))
        fs.delete(folder, True)
        return self._update(lambda runs: (*runs, *new))

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, the newest if none is named."""
        return self._read(tuple(p for r in self.manifest(version).runs for p in r.paths))

    def _due(self, runs: tuple[Run, ...]) -> list[Run]:
        """The runs of the lowest tier that has FANOUT of them, else those of far too small shards, else none."""
        tiers: dict[int, list[Run]] = {}
        for run in runs:
            tiers.setdefault(run.tier, []).append(run)
        full = next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= FANOUT), None)
        return full or [r for r in runs if r.undersized(self.target_bytes)]

    def merge(self, old: list[Run]) -> Run:
        """One run of target-sized shards with the rows of the old ones; runs of such shards are taken over as they are."""
        small = [r for r in old if not r.full(self.target_bytes)]
        whole = [r for r in old if r.full(self.target_bytes)]
        if small:
            path = f"{self.root}/data/{uuid.uuid4().hex}"
            files = max(1, math.ceil(sum(r.bytes for r in small) / self.target_bytes))
            self._read(tuple(p for r in small for p in r.paths)).coalesce(files).write.option("compression", "zstd").parquet(path)
            run = self._run(path)
            if run.rows != sum(r.rows for r in small):
                raise RuntimeError(f"a merge of {sum(r.rows for r in small)} rows wrote {run.rows}")
            whole.append(run)
        return reduce(Run.__add__, whole)

    def compact(self) -> Manifest:
        """Merge until no tier has FANOUT runs and no run far too small shards; each merge is a version."""
        while old := self._due(self.manifest().runs):
            run, gone = self.merge(old), {r.paths for r in old}

            def swap(runs: tuple[Run, ...], run: Run = run, gone: set[str] = gone) -> tuple[Run, ...]:
                if not gone <= {r.paths for r in runs}:
                    return runs  # another writer has merged some of them: this merge is dropped
                return (*(r for r in runs if r.paths not in gone), run)

            self._update(swap)
        return self.manifest()

    def vacuum(self, keep_versions: int = 1) -> None:
        """Delete all but the newest versions and the data that only older ones name.

        Not to be called while another writer is at work: its run isn't named yet.
        """
        versions = self.versions()
        live = {p.rsplit("/", 1)[1] for v in versions[-keep_versions:] for r in self.manifest(v).runs for p in r.paths}
        fs, folder = file_system(self.spark, f"{self.root}/data")
        if fs.exists(folder):
            for status in fs.listStatus(folder):
                if status.getPath().getName() not in live:
                    fs.delete(status.getPath(), True)
        for version in versions[:-keep_versions]:
            fs.delete(file_system(self.spark, self._version_path(version))[1], False)
