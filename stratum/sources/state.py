"""Keyed state tables as versioned Parquet: buckets of a base run and delta runs.

A table's rows lie in buckets by a hash of their key.  A bucket is a list of
runs, each a folder `_v=<n>/__bucket=<b>`; of a key the row in the latest run
counts.  An upsert adds a run with its own rows to the buckets that it touches,
so what it writes grows with the increment and not with the table.  Runs are
folded by size: a bucket's latest runs become one when several of a size have
gathered, and all of them become a new base when the deltas have grown to a
share of it; each row is thus rewritten a number of times that grows with the
logarithm of the table.

Buckets grow by linear hashing: where rows outnumber what the buckets should
hold, one bucket after the other is split in two, and the others stay.

A version is a small manifest of runs with their rows and the range of the
first key column, by which a merge leaves out runs that hold none of its keys.
It notes which runs had their keys checked, and, for a table that is counted by
a column, the rows of the table and the folder of its counts by that column.
A commit that knows which stored rows it replaces brings the counts up to date
by the difference; one that doesn't leaves them out, and they are made anew when
they are next asked for in a merge.

A writer takes the table's lock, writes its rows once to a staging folder, where
they are counted by bucket and checked, and then each of them to the one bucket
folder in which it stays: that of its own run, or of the run into which its
bucket is folded.  Then it writes the manifest and makes the version the current
one; readers see one version or the next.  The version
before stays as a backup.  There is one writer of a table at a time.

Which versions are current stands in the state's log: each entry names those of
all tables and appears by a rename that fails if the entry is taken.  The
commits of a transaction appear in one entry, all or none.  A table outside a
state has a pointer file of its own.  Locks, log and pointers need a file system
whose renames are atomic.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import latest_per_key
from ..operators.normalize import add_defaults, fit_schema
from ..operators.upsert import repeated_keys
from ..schemas import DEFAULTS, INTERNAL_TABLES, OLD_TABLES, PARENTS, REQUIRED, TABLES
from .files import create_new, delete, few_listing_tasks, listing, publish_new, read_text, require_atomic_rename, write_text

BUCKET = "__bucket"
#: Columns by whose values the rows of a table are counted at each commit.
COUNTED = {"silver_ig_posts": "source_dataset"}
#: Tables that grow with the data; the others are small and have one bucket.
LARGE_TABLES = frozenset(("silver_ig_posts", "gold_ig_analyses", "dead_letter", "dim_profile", "silver_posts", "gold_analyses"))


class ConstraintViolation(ValueError):
    """Rows that a table refuses; nothing of their commit remains."""


class KeyViolation(ConstraintViolation):
    """A key is null or held more than once."""


class MissingValue(ConstraintViolation):
    """A required column is null."""


class MissingParent(ConstraintViolation):
    """A foreign key names a row that isn't there."""


class Locked(RuntimeError):
    """Another writer is at work."""


class NoTable(LookupError):
    """A table that must be there has not been written."""


#: A bucket's latest runs are folded when so many of a size have gathered; a size is a power of this.
FAN = 4
#: All runs of a bucket are folded when the deltas have this share of the base's rows.
FOLD_SHARE = 0.5
#: Keys of delta runs that may be broadcast to a read; more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000
#: Rows that a bucket of a large table should have at most, some hundred megabytes of posts.
BUCKET_ROWS = 1_000_000
_VERSION = "__version"


def first_to_fold(rows: list[int]) -> int | None:
    """Number of the run from which on a bucket's runs are folded, given their rows, the base first; None: none are."""
    if len(rows) > 1 and sum(rows[1:]) >= FOLD_SHARE * rows[0]:
        return 0
    sizes = [_size(n) for n in rows]
    found, largest = None, -1
    for start in range(len(rows) - 1, 0, -1):
        largest = max(largest, sizes[start])
        if sizes[start:].count(largest) >= FAN:
            found = start
    return found


def _size(rows: int) -> int:
    """Power of FAN that a number of rows has reached."""
    power = 0
    while rows >= FAN:
        rows, power = rows // FAN, power + 1
    return power


def level(first: int, buckets: int) -> int:
    """The largest first * 2**k that isn't above a number of buckets."""
    while first * 2 <= buckets:
        first *= 2
    return first


def bucket_of(keys: tuple[str, ...], first: int, buckets: int) -> Column:
    """Linear hashing: the remainder by twice the level, or by the level where that bucket isn't there yet."""
    low, h = level(first, buckets), F.xxhash64(*keys)
    wide = F.pmod(h, F.lit(2 * low))
    return F.when(wide < buckets, wide).otherwise(F.pmod(h, F.lit(low))).cast("int")


def split_buckets(first: int, old: int, new: int) -> set[int]:
    """Buckets of `old` whose rows are dealt anew when there are `new`."""
    found = set()
    for bucket in range(old, new):
        while bucket >= old:
            bucket -= level(first, bucket)
        found.add(bucket)
    return found


class _Pointer:
    """The current version of a table by itself, in the file `_CURRENT`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/_CURRENT"

    def get(self) -> int:
        return int(read_text(self.spark, self.path) or 0)

    def set(self, version: int, clean: Callable[[], None]) -> None:
        write_text(self.spark, self.path, str(version))
        clean()


class Log:
    """Entries `_log/<n>.json` of the current versions by table."""

    KEPT = 20

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root}/_log"

    def _numbers(self) -> list[int]:
        return sorted(int(f.stem) for f in listing(self.spark, self.folder) if f.name.endswith(".json") and f.stem.isdigit())

    def current(self) -> dict[str, int]:
        numbers = self._numbers()
        return json.loads(read_text(self.spark, f"{self.folder}/{numbers[-1]:012d}.json") or "{}") if numbers else {}

    def append(self, changes: dict[str, int]) -> None:
        """Add an entry with other versions of some tables; again, if another writer's entry came first."""
        while True:
            numbers = self._numbers()
            number = numbers[-1] + 1 if numbers else 1
            if publish_new(self.spark, f"{self.folder}/{number:012d}.json", json.dumps(self.current() | changes)):
                break
        for old in numbers[: -self.KEPT]:
            delete(self.spark, f"{self.folder}/{old:012d}.json")


class _InState(_Pointer):
    """The current version of a table by the log of its state, or by an open transaction."""

    def __init__(self, state: State, name: str):
        super().__init__(state.spark, f"{state.root}/{name}")
        self.state, self.name = state, name

    def get(self) -> int:
        for known in (self.state.open_versions or {}, self.state.log.current()):
            if self.name in known:
                return known[self.name]
        return super().get()  # written before there was a log

    def set(self, version: int, clean: Callable[[], None]) -> None:
        if self.state.open_versions is None:
            self.state.log.append({self.name: version})
            clean()
        else:
            self.state.open_versions[self.name] = version
            self.state.afterwards.append(clean)


@dataclass(frozen=True)
class Constraints:
    """What a table asks of the rows that are committed to it, beside its keys.

    `parent` is (column, the table of whose key it is one).  Only the rows of a
    commit are held against it; the parent doesn't refuse to lose rows.
    """

    required: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    parent: tuple[str, StateTable] | None = None


class StateTable:
    """A table of one schema and key.

    `buckets` is the number of the first version.  With `bucket_rows` it grows,
    so that a bucket has about so many rows at most; without, it stays.
    `counted` is a column by whose values rows are counted at each commit.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: tuple[str, ...], buckets: int = 1, keep_versions: int = 2, bucket_rows: int | None = None, pointer: _Pointer | None = None, counted: str | None = None, constraints: Constraints | None = None):
        require_atomic_rename(path)
        self.pointer, self.counted, self.constraints = pointer or _Pointer(spark, path.rstrip("/")), counted, constraints or Constraints()
        self.spark, self.path, self.schema, self.keys, self.buckets, self.keep_versions, self.bucket_rows = spark, path.rstrip("/"), schema, keys, buckets, keep_versions, bucket_rows

    def version(self) -> int:
        """Number of the current version, 0 before the first commit."""
        return self.pointer.get()

    def _manifest(self, version: int) -> dict:
        """{first, buckets, runs}: the first and today's number of buckets, and the runs {folder, rows, low, high} of each bucket that has some."""
        if not version:
            return {"first": self.buckets, "buckets": self.buckets, "runs": {}}
        found = json.loads(read_text(self.spark, f"{self.path}/_manifest-{version}") or "")
        if "folders" in found:  # of the layout before there were runs
            return {"first": found["buckets"], "buckets": found["buckets"], "runs": {b: [{"folder": str(v), "rows": 0, "low": None, "high": None}] for b, v in found["folders"].items()}}
        return found

    def runs(self, version: int | None = None) -> dict[int, list[dict]]:
        """The runs of each bucket, the base first."""
        return {int(b): r for b, r in self._manifest(self.version() if version is None else version)["runs"].items()}

    def _folder(self, name: str, bucket: str | int = "") -> str:
        return f"{self.path}/_v={name}" + (f"/{BUCKET}={bucket}" if bucket != "" else "")

    def _load(self, folders: list[str], schema: T.StructType | None = None) -> DataFrame:
        schema = schema or self.schema
        if not folders:
            return self.spark.createDataFrame([], schema)
        with few_listing_tasks(self.spark):
            return self.spark.read.schema(schema).parquet(*folders)

    def _rows(self, runs: dict[str, list[dict]]) -> DataFrame:
        """The latest row of each key in these runs.

        Bases are scanned without a shuffle; rows whose key a delta holds are
        left out by the deltas' keys, of which the manifest knows the number.
        """
        paths = {b: [self._folder(r["folder"], b) for r in own] for b, own in sorted(runs.items()) if own}
        single = self._load([p[0] for p in paths.values() if len(p) == 1])
        bases, deltas = [p[0] for p in paths.values() if len(p) > 1], [x for p in paths.values() for x in p[1:]]
        if not deltas:
            return single
        order = F.regexp_extract("_metadata.file_path", r"/_v=(\d+)f?/", 1).cast("long").alias(_VERSION)
        stored = self._load(deltas)
        later = latest_per_key(stored.select("*", order), self.keys, [F.desc(_VERSION)]).drop(_VERSION)
        keys = stored.select(*self.keys)
        if sum(r["rows"] for own in runs.values() for r in own[1:]) <= BROADCAST_KEYS:
            keys = F.broadcast(keys)
        rest = self._load(bases).join(keys, list(self.keys), "left_anti").select(*self.schema.names)
        return reduce(DataFrame.unionAll, [single, rest, later] if len(paths) > len(bases) else [rest, later])

    def read(self, version: int | None = None, required: bool = False) -> DataFrame:
        """Rows of a version, by default the current one; columns that it lacks are null.

        A table that has not been written is empty, or raises NoTable if it is required.
        """
        version = self.version() if version is None else version
        if required and not version:
            raise NoTable(self.path)
        return self._rows(self._manifest(version)["runs"])

    def lookup(self, *keys: tuple) -> DataFrame:
        """Rows with the given keys, each a tuple of the key columns; reads their buckets only."""
        manifest = self._manifest(self.version())
        wanted = self.spark.createDataFrame(list(keys), T.StructType([self.schema[k] for k in self.keys]))
        found = {str(r[0]) for r in wanted.select(bucket_of(self.keys, manifest["first"], manifest["buckets"])).distinct().collect()}  # numbers of buckets
        rows = self._rows({b: r for b, r in manifest["runs"].items() if b in found})
        return rows.join(F.broadcast(wanted), list(self.keys), "left_semi")

    def counts(self, version: int | None = None) -> DataFrame:
        """(counted column, n_rows) of a version: as its commit noted them, else by a scan of that column."""
        version = self.version() if version is None else version
        noted = self._manifest(version).get("counts")
        if noted is None:
            return self.read(version).groupBy(self.counted).agg(F.count("*").alias("n_rows"))
        return self.spark.read.schema(self._counts_schema()).parquet(f"{self.path}/_counts-{noted}")

    def n_rows(self) -> int:
        """Rows of the current version: as its commit noted them, else by a scan."""
        version = self.version()
        noted = self._manifest(version).get("total")
        return self.read(version).count() if noted is None else noted

    def keys_checked(self) -> bool:
        """Whether the keys of all runs of the current version were checked when these were committed."""
        return all(r.get("checked") for own in self.runs().values() for r in own)

    def _counts_schema(self) -> T.StructType:
        return T.StructType([self.schema[self.counted], T.StructField("n_rows", T.LongType())])

    def _note_counts(self, version: int, before: DataFrame, added: DataFrame, gone: DataFrame | None = None) -> dict:
        """Write the counts of a version: those before, and the rows that come, less those that go."""
        if not self.counted:
            return {}
        parts = [before, *(df.groupBy(self.counted).agg((F.count("*") * sign).alias("n_rows")) for df, sign in ((added, 1), (gone, -1)) if df is not None)]
        sums = reduce(DataFrame.unionByName, parts).groupBy(self.counted).agg(F.sum("n_rows").alias("n_rows")).where("n_rows > 0")
        folder = f"{self.path}/_counts-{version}"
        sums.write.mode("overwrite").parquet(folder)
        total = self.spark.read.schema(self._counts_schema()).parquet(folder).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
        return {"counts": version, "total": total}

    def _no_counts(self) -> DataFrame:
        return self.spark.createDataFrame([], self._counts_schema())

    @contextmanager
    def lock(self) -> Iterator[None]:
        path = f"{self.path}/_LOCK"
        if not create_new(self.spark, path, str(time.time())):
            raise Locked(f"{self.path} is being written (or a writer died: then delete _LOCK)")
        try:
            yield
        finally:
            delete(self.spark, self._staging(""))
            delete(self.spark, path)

    def _staging(self, name: str) -> str:
        """A folder for what a writer needs until its lock goes."""
        return f"{self.path}/_staging/{name}".rstrip("/")

    def _sizes(self, df: DataFrame, bucket: Column) -> dict[str, dict]:
        """Rows and range of keys of the buckets that have some."""
        first_key = self.keys[0]
        ordered = isinstance(self.schema[first_key].dataType, T.StringType | T.IntegerType | T.LongType)
        ends = [(f(first_key) if ordered else F.lit(None)).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))]
        found = df.groupBy(bucket.alias(BUCKET)).agg(F.count("*").alias("rows"), *ends)
        return {str(r[BUCKET]): {"rows": r.rows, "low": r.low, "high": r.high} for r in found.collect()}  # a row for each bucket

    def _stage(self, df: DataFrame, name: str, manifest: dict) -> tuple[DataFrame, dict[str, dict]]:
        """Write rows as they come, in place of what a writer that died left there; the rows, and the sizes of their buckets."""
        df.write.mode("overwrite").parquet(self._staging(name))
        rows = self._load([self._staging(name)])
        return rows, self._sizes(rows, bucket_of(self.keys, manifest["first"], manifest["buckets"]))

    def _write(self, df: DataFrame, folder: str, manifest: dict) -> None:
        """Write rows by bucket in place of what a writer that died left there."""
        buckets = manifest["buckets"]
        rows = df.select("*", bucket_of(self.keys, manifest["first"], buckets).alias(BUCKET))
        (rows.repartition(BUCKET) if buckets > 1 else rows).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)

    def _written(self, folder: str) -> dict[str, dict]:
        """The sizes of the buckets in a folder."""
        if not any(f.name.startswith(f"{BUCKET}=") for f in listing(self.spark, folder)):
            return {}
        keys = T.StructType([self.schema[self.keys[0]], T.StructField(BUCKET, T.IntegerType())])
        with few_listing_tasks(self.spark):
            rows = self.spark.read.schema(keys).option("basePath", folder).parquet(folder)
        return self._sizes(rows, F.col(BUCKET))

    def _check(self, rows: DataFrame) -> None:
        """Raise for keys that are null or repeated; reads the keys only."""
        if broken := repeated_keys(rows.select(*self.keys), self.keys).limit(5).collect():
            raise KeyViolation(f"{self.path}: {[r.asDict() for r in broken]}")

    def missing_keys(self, keys: DataFrame, n_keys: int) -> DataFrame:
        """Those of `n_keys` distinct keys (the key columns) that the table doesn't hold.

        Of the table it reads the key columns, in the buckets of these keys and
        there in the runs whose range they meet.  Up to BROADCAST_KEYS keys go to
        that scan; more are joined by a shuffle.
        """
        manifest, keys = self._manifest(self.version()), keys.select(*self.keys)
        ends = [f(self.keys[0]).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))]
        asked = keys.select("*", bucket_of(self.keys, manifest["first"], manifest["buckets"]).alias(BUCKET)).groupBy(BUCKET).agg(*ends).collect()  # a row for each bucket
        ranges = {str(r[BUCKET]): {"low": r.low, "high": r.high} for r in asked}
        folders = [self._folder(r["folder"], b) for b, own in sorted(manifest["runs"].items()) if b in ranges for r in own if _meet(r, ranges[b])]
        held = self._load(folders, T.StructType([self.schema[k] for k in self.keys]))
        if n_keys <= BROADCAST_KEYS:
            held = F.broadcast(held.join(F.broadcast(keys), list(self.keys), "left_semi").distinct())  # as many rows as keys at most
        return keys.join(held, list(self.keys), "left_anti")

    def _check_constraints(self, rows: DataFrame, sizes: dict[str, dict]) -> None:
        """Raise for rows of a run that lack a required value or a parent; reads these columns only."""
        required, parent = self.constraints.required, self.constraints.parent
        if required:
            nulls = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in required)).first().asDict()
            if found := {c: n for c, n in nulls.items() if n}:
                raise MissingValue(f"{self.path}: nulls in {found}")
        if parent:
            column, table = parent
            keys = rows.select(F.col(column).alias(table.keys[0])).where(F.col(table.keys[0]).isNotNull()).distinct()
            if lost := table.missing_keys(keys, sum(s["rows"] for s in sizes.values())).limit(5).collect():
                raise MissingParent(f"{self.path}: no row of {table.path} for {[r[0] for r in lost]}")

    def _fit(self, df: DataFrame) -> DataFrame:
        """Rows in the table's schema, with defaults for the columns that they lack."""
        return fit_schema(add_defaults(df, self.constraints.defaults, self.schema), self.schema)

    def _stage_run(self, df: DataFrame, manifest: dict) -> tuple[DataFrame, dict[str, dict]]:
        """Stage and check the rows of a version."""
        rows, sizes = self._stage(df, "run", manifest)
        self._check(rows)
        self._check_constraints(rows, sizes)
        return rows, sizes

    def _folded(self, past: dict[str, list[dict]], fresh: DataFrame, n_fresh: int) -> DataFrame:
        """The latest row of each key in runs and in `n_fresh` rows after them."""
        if not any(past.values()):
            return fresh
        keys = fresh.select(*self.keys)
        rest = self._rows(past).join(F.broadcast(keys) if n_fresh <= BROADCAST_KEYS else keys, list(self.keys), "left_anti")
        return rest.select(*self.schema.names).unionAll(fresh)

    def _commit(self, version: int, manifest: dict, rows: DataFrame, sizes: dict[str, dict], counts: dict | None = None) -> int:
        """Make staged rows the last runs of their buckets, with the counts of the version; fold and split buckets where it is time.

        Rows of buckets that are folded go to the folded run at once, the others to one of their own.
        """
        runs = {b: list(r) for b, r in manifest["runs"].items()}
        for b, s in sizes.items():
            runs.setdefault(b, []).append({"folder": str(version), "checked": True, **s})
        old = buckets = manifest["buckets"]
        if self.bucket_rows:
            buckets = max(old, -(-sum(r["rows"] for own in runs.values() for r in own) // self.bucket_rows))
        starts = {b: start for b in sizes if (start := first_to_fold([r["rows"] for r in runs[b]])) is not None}
        starts |= {str(b): 0 for b in split_buckets(manifest["first"], old, buckets) if str(b) in runs}
        made = {"first": manifest["first"], "buckets": buckets, "runs": runs, **(counts or {})}
        own, fresh = [b for b in sizes if b not in starts], [b for b in sizes if b in starts]

        def among(names: list[str]) -> DataFrame:
            if len(names) == len(sizes):
                return rows
            bucket = bucket_of(self.keys, manifest["first"], old).alias(BUCKET)
            return rows.select("*", bucket).where(f"{BUCKET} IN ({', '.join(names or ['-1'])})").drop(BUCKET)

        if own:
            self._write(among(own), self._folder(str(version)), manifest)
        if starts:
            name, checked = f"{version}f", all(r.get("checked") for b, start in starts.items() for r in runs[b][start:])
            past = {b: [r for r in runs[b][start:] if r["folder"] != str(version)] for b, start in starts.items()}
            self._write(self._folded(past, among(fresh), sum(sizes[b]["rows"] for b in fresh)), self._folder(name), made)
            for b, start in starts.items():
                del runs[b][start:]
            for b, s in self._written(self._folder(name)).items():
                runs.setdefault(b, []).append({"folder": name, "checked": checked, **s})
        made["runs"] = {b: r for b, r in runs.items() if r}
        write_text(self.spark, f"{self.path}/_manifest-{version}", json.dumps(made))
        self.pointer.set(version, lambda: self._clean(version))
        return version

    def _clean(self, version: int) -> None:
        """Delete older versions than are kept, and the folders that only they name."""
        live: set[tuple[str, str]] = set()
        gone: set[tuple[str, str]] = set()
        counts: set[str] = set()
        old = []
        found = listing(self.spark, self.path)
        for f in found:
            if f.name.startswith("_manifest-"):
                number = int(f.name[len("_manifest-") :])
                manifest = self._manifest(number)
                parts = {(r["folder"], b) for b, own in manifest["runs"].items() for r in own}
                if number <= version - self.keep_versions:
                    old.append(f.path)
                    gone |= parts
                else:
                    live |= parts
                    counts.add(f"_counts-{manifest.get('counts')}")
        kept = {folder for folder, _ in live}
        for f in found:
            if (f.name.startswith("_counts-") and f.name not in counts) or (f.name.startswith("_v=") and f.name[len("_v=") :] not in kept):
                delete(self.spark, f.path)
        for folder, b in gone - live:
            if folder in kept:
                delete(self.spark, self._folder(folder, b))
        for path in old:
            delete(self.spark, path)

    def replace(self, df: DataFrame) -> int:
        """Make these rows the next version."""
        with self.lock():
            version = self.version()
            manifest = self._manifest(version) | {"runs": {}}
            rows, sizes = self._stage_run(self._fit(df), manifest)
            counts = self._note_counts(version + 1, self._no_counts(), rows) if self.counted else {}
            return self._commit(version + 1, manifest, rows, sizes, counts)

    def upsert(self, source: DataFrame) -> int:
        """Replace rows by key, add those with new keys; columns are bound by name.

        Stored rows aren't read, but where runs are folded; so the first version only has its rows counted.
        """
        with self.lock():
            version = self.version()
            manifest = self._manifest(version)
            rows, sizes = self._stage_run(self._fit(source), manifest)
            counts = self._note_counts(version + 1, self._no_counts(), rows) if self.counted and not manifest["runs"] else {}
            return self._commit(version + 1, manifest, rows, sizes, counts)

    def merge(self, source: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], unique: bool = False) -> int:
        """Upsert combine(stored rows with a key of the source, source rows), which gives a row for each of these keys.

        The source is evaluated once, into a staging folder.  With `unique` its
        keys are checked there.  Of the stored runs those are read whose bucket
        and range of keys the source touches; rows that come out as they were
        stored aren't written again.
        """
        with self.lock():
            version = self.version()
            manifest = self._manifest(version)
            new, asked = self._stage(self._fit(source), "source", manifest)
            if unique:
                self._check(new)
            touched = {b: met for b, own in manifest["runs"].items() if b in asked and (met := [r for r in own if _meet(r, asked[b])])}
            old, changed = self._load([]), fit_schema(combine(self._load([]), new), self.schema)
            if touched:
                keys = new.select(*self.keys) if unique else new.select(*self.keys).distinct()
                self._rows(touched).join(keys, list(self.keys), "left_semi").select(*self.schema.names).write.mode("overwrite").parquet(self._staging("stored"))
                old = self._load([self._staging("stored")])
                unchanged = reduce(Column.__and__, (F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in self.schema.names))
                changed = fit_schema(combine(old, new), self.schema).alias("a").join(old.alias("b"), unchanged, "left_anti")
            rows, sizes = self._stage_run(changed, manifest)
            counts = {}
            if self.counted:
                counts = self._note_counts(version + 1, self.counts(version), rows, old.join(rows.select(*self.keys), list(self.keys), "left_semi"))
            return self._commit(version + 1, manifest, rows, sizes, counts)

    def delete_where(self, condition: str) -> int:
        """Drop the rows that fulfil a condition; the buckets that hold some are written anew."""
        with self.lock():
            version = self.version()
            manifest = self._manifest(version)
            hit = F.coalesce(F.expr(condition), F.lit(False))
            bucket = bucket_of(self.keys, manifest["first"], manifest["buckets"])
            touched = {str(r[0]) for r in self._rows(manifest["runs"]).where(hit).select(bucket).distinct().collect()}  # numbers of buckets
            kept = {b: r for b, r in manifest["runs"].items() if b not in touched}
            rows = self._rows({b: r for b, r in manifest["runs"].items() if b in touched})
            counts = self._note_counts(version + 1, self.counts(version), self._load([]), rows.where(hit)) if self.counted else {}
            return self._commit(version + 1, manifest | {"runs": kept}, *self._stage_run(rows.where(~hit), manifest), counts)

    def delete_keys(self, keys: DataFrame) -> int:
        """Drop the rows with these keys; their buckets are written anew."""
        with self.lock():
            version = self.version()
            manifest = self._manifest(version)
            keys.select(*self.keys).distinct().write.mode("overwrite").parquet(self._staging("keys"))
            gone = self.spark.read.schema(T.StructType([self.schema[k] for k in self.keys])).parquet(self._staging("keys"))
            touched = {str(r[0]) for r in gone.select(bucket_of(self.keys, manifest["first"], manifest["buckets"])).distinct().collect()}  # numbers of buckets
            kept = {b: r for b, r in manifest["runs"].items() if b not in touched}
            rows = self._rows({b: r for b, r in manifest["runs"].items() if b in touched})
            counts = self._note_counts(version + 1, self.counts(version), self._load([]), rows.join(gone, list(self.keys), "left_semi")) if self.counted else {}
            return self._commit(version + 1, manifest | {"runs": kept}, *self._stage_run(rows.join(gone, list(self.keys), "left_anti").select(*self.schema.names), manifest), counts)

    def drop(self) -> None:
        self.pointer.set(0, lambda: delete(self.spark, self.path))


def _meet(a: dict, b: dict) -> bool:
    """Whether the key ranges of two runs meet; unknown ones do."""
    return None in (a["low"], a["high"], b["low"], b["high"]) or a["low"] <= b["high"] and b["low"] <= a["high"]


class State:
    """The tables of a pipeline under one folder.  Large tables start with `buckets` buckets, which grow as the rows do."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.root, self.buckets, self.bucket_rows = spark, root.rstrip("/"), buckets, bucket_rows
        self.log = Log(spark, self.root)
        self.open_versions: dict[str, int] | None = None
        self.afterwards: list[Callable[[], None]] = []

    @contextmanager
    def transaction(self) -> Iterator[None]:
        """Commits to tables of this state inside it become current together, when it ends; none do if it fails.

        Inside, this object's tables read what was committed inside; others
        read the versions of before.  What a transaction that failed has
        written is overwritten by the next commit.
        """
        if self.open_versions is not None:
            raise RuntimeError("a transaction is open")
        self.open_versions, self.afterwards = {}, []
        try:
            yield
            made, later = self.open_versions, self.afterwards
        finally:
            self.open_versions, self.afterwards = None, []
        if made:
            self.log.append(made)
        for clean in later:
            clean()

    def table(self, name: str) -> StateTable:
        schema, keys = (TABLES | OLD_TABLES | INTERNAL_TABLES)[name]
        return StateTable(self.spark, f"{self.root}/{name}", schema, keys, self.buckets if name in LARGE_TABLES else 1, bucket_rows=self.bucket_rows, pointer=_InState(self, name), counted=COUNTED.get(name))

    def guarded(self, name: str) -> StateTable:
        """The table with its required columns, defaults and foreign key, as the steps write to it."""
        table, link = self.table(name), PARENTS.get(name)
        table.constraints = Constraints(REQUIRED.get(name, ()), DEFAULTS.get(name, {}), link and (link[0], self.table(link[1])))
        return table

    def exists(self, name: str) -> bool:
        return _InState(self, name).get() > 0

    def names(self) -> list[str]:
        """Tables that have been written, by name."""
        return [f.name for f in listing(self.spark, self.root) if f.is_dir and not f.name.startswith("_") and f.name not in INTERNAL_TABLES and self.exists(f.name)]

    def drop_all(self) -> None:
        delete(self.spark, self.root)

    # -- marks --

    def advance(self, name: str, timestamp: object, config_hash: str | None = None) -> None:
        """Set a named mark; without a hash the old one stays."""
        marks = self.guarded("watermarks")
        new = self.spark.createDataFrame([(name,)], "name string").select("name", F.lit(timestamp).cast("timestamp_ntz").alias("timestamp"), F.lit(config_hash).cast("string").alias("config_hash"))
        old = marks.read().select("name", F.col("config_hash").alias("old_hash"))
        marks.upsert(new.join(old, "name", "left").select("name", "timestamp", F.coalesce("config_hash", "old_hash").alias("config_hash")))

    def mark(self, name: str) -> object | None:
        row = self.table("watermarks").read().where(F.col("name") == name).first()
        return row.timestamp if row else None

    def reset(self, name: str) -> None:
        """Forget a mark, so that the next run takes everything again."""
        self.table("watermarks").delete_where(f"name = '{name}'")
