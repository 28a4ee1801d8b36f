"""Scans of the bronze layer: datasets of Parquet whose schemas drift.

Tasks list files and read their footers; the driver learns a schema from
a footer's own note of it, or infers it once for each distinct one.
"""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import File, arrow_file_system, listing

log = logging.getLogger(__name__)

PARTITION = "dataset_id="
#: Column with the file that a scanned row is from.
FILE = "__file"
#: Key under which Spark's writer notes a schema in a footer.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
#: (dataset_id, path, file, modified_ms, n_bytes, n_rows, fingerprint, schema, error) of a file; `file` as scans name it.
FOOTERS = "dataset_id string, path string, file string, modified_ms long, n_bytes long, n_rows long, fingerprint string, schema string, error string"


@dataclass(frozen=True)
class Dataset:
    """A flat file `<id>.parquet` or a folder `dataset_id=<id>`."""

    id: str
    path: str
    modified_ms: int


def datasets(spark: SparkSession, folder: str, after_ms: int | None = None) -> list[Dataset]:
    """Datasets in a folder by id; with a mark, those with data that is newer."""
    found = []
    for f in listing(spark, folder):
        if f.is_dir and f.name.startswith(PARTITION):
            newest = max((p.modified_ms for p in _parts(spark, f)), default=f.modified_ms)
            found.append(Dataset(f.name[len(PARTITION) :], f.path, newest))
        elif f.name.endswith(".parquet"):
            newest = max((p.modified_ms for p in _parts(spark, f)), default=f.modified_ms) if f.is_dir else f.modified_ms
            found.append(Dataset(f.stem, f.path, newest))
    return sorted((d for d in found if after_ms is None or d.modified_ms > after_ms), key=lambda d: d.id)


def _parts(spark: SparkSession, folder: File) -> list[File]:
    return [p for p in listing(spark, folder.path) if p.name.endswith(".parquet")]


def newest(spark: SparkSession, folder: str) -> Dataset | None:
    return max(datasets(spark, folder), key=lambda d: (d.modified_ms, d.id), default=None)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A dataset, or None where no footer can be read."""
    try:
        return spark.read.option("mergeSchema", "false").parquet(path)
    except Exception as problem:  # noqa: BLE001  a file that can't be read is quarantined, not fatal
        log.warning("skipping unreadable dataset %s: %s", path, str(problem).splitlines()[0])
        return None


def dataset_of_path(path: Column) -> Column:
    """Id of the dataset that a file belongs to: a flat file's stem, or the name of its folder."""
    partition = F.regexp_extract(path, "/" + PARTITION + "([^/]+)/[^/]*$", 1)
    folder = F.regexp_extract(path, r"/([^/]+)\.parquet/[^/]*$", 1)
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.parquet$", "")
    return F.when(partition != "", partition).when(folder != "", folder).otherwise(stem)


def dataset_of_file() -> Column:
    """Id of the dataset that a scanned row is from."""
    return F.url_decode(dataset_of_path(F.col("_metadata.file_path")))


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(dataset_id, path, file, modified_ms, n_bytes) of the Parquet files of datasets, or of all datasets in a folder.

    Spark lists, in tasks where there are many folders; contents aren't read.
    """
    if not paths:
        return spark.createDataFrame([], "dataset_id string, path string, file string, modified_ms long, n_bytes long")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(list(paths))
    return found.select(dataset_of_path(F.col("path")).alias("dataset_id"), "path", F.col("_metadata.file_path").alias("file"), F.unix_millis("modificationTime").alias("modified_ms"), F.col("length").alias("n_bytes"))


def _footer(fs, path: str) -> tuple[int | None, str | None, str | None, str | None]:
    """(rows, fingerprint, Spark's note of the schema, what is wrong) of a file."""
    from pyarrow import parquet

    try:
        with fs.open_input_file(path) as file:
            meta = parquet.read_metadata(file)
    except (PermissionError, NotADirectoryError):
        raise
    except (pa.ArrowException, OSError, EOFError) as problem:  # also of a file that went meanwhile
        return None, None, None, str(problem).splitlines()[0][:300]
    note = (meta.metadata or {}).get(_SPARK_SCHEMA)
    told = note.decode() if note is not None else str(meta.schema).partition("\n")[2]  # behind the object's address
    return meta.num_rows, hashlib.sha256(told.encode()).hexdigest()[:32], None if note is None else note.decode(), None


def footers(files: DataFrame) -> DataFrame:
    """Files with what their footers say (FOOTERS), read by tasks; `error` where a footer can't be read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_footer(*arrow_file_system(path)) for path in batch.column("path").to_pylist()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), (pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)] if found else [pa.array([], pa.int64()), *[pa.array([], pa.string())] * 3]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "n_rows", "fingerprint", "schema", "error"])

    return files.select("dataset_id", "path", "file", "modified_ms", "n_bytes").mapInArrow(read, FOOTERS)


@dataclass(frozen=True)
class BronzeScan:
    """Frames of datasets with the same schema, and the ids of those that are read, damaged (with the reason), and without an id column."""

    frames: list[DataFrame]
    read: list[str]
    damaged: dict[str, str]
    idless: list[str]

    @property
    def skipped(self) -> list[str]:
        return sorted([*self.damaged, *self.idless])


def scan_files(spark: SparkSession, known: DataFrame, dataset_column: str = "source_dataset", id_columns: tuple[str, ...] = ("id", "post_id"), with_files: bool = False) -> BronzeScan:
    """Read the datasets of files whose footers are known, one scan for each distinct schema.

    A dataset with a file that can't be read is damaged as a whole.  Parts of a
    dataset may differ in schema.  Rows of a part whose pages turn out to be
    damaged are missing from the frames: compare counts by FILE (added with
    `with_files`) with the footers'.
    """
    rows = known.select("dataset_id", "path", "fingerprint", "schema", "error").collect()  # a row for each file to be read
    damaged = {r.dataset_id: f"{r.path}: {r.error}" for r in rows if r.error is not None}
    groups: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: r.path):
        if r.dataset_id not in damaged:
            groups.setdefault(r.fingerprint, []).append(r)
    schemas = {f: T.StructType.fromJson(json.loads(own[0].schema)) if own[0].schema else spark.read.parquet(own[0].path).schema for f, own in groups.items()}
    idless = {r.dataset_id for f, own in groups.items() for r in own if not set(id_columns) & set(schemas[f].names)}
    frames = []
    for fingerprint, own in groups.items():
        paths = [r.path for r in own if r.dataset_id not in idless]
        if not paths:
            continue
        reader = spark.read.schema(schemas[fingerprint]).option("ignoreCorruptFiles", "true").option("parquet.page.verify-checksum.enabled", "true")
        df = reader.parquet(*paths)
        more = [] if dataset_column in df.columns else [dataset_of_file().alias(dataset_column)]
        frames.append(df.select("*", *more, *([F.col("_metadata.file_path").alias(FILE), dataset_of_file().alias(f"{FILE}_dataset")] if with_files else [])))
    for d, reason in damaged.items():
        log.warning("skipping dataset %s: %s", d, reason)
    for d in idless:
        log.warning("skipping dataset %s: it has no id column", d)
    read = sorted({r.dataset_id for r in rows} - set(damaged) - idless)
    return BronzeScan(frames, read, damaged, sorted(idless))


def scan(spark: SparkSession, found: list[Dataset], dataset_column: str = "source_dataset", id_columns: tuple[str, ...] = ("id", "post_id")) -> BronzeScan:
    """Read datasets: footers by tasks, then one scan for each distinct schema.

    Datasets that can't be read or have no id column are left out and reported.
    """
    return scan_files(spark, footers(list_files(spark, *(d.path for d in found))), dataset_column, id_columns)


def newer_than(df: DataFrame, mark: Column, column: str = "_metadata.file_modification_time") -> DataFrame:
    """Rows whose file (or whose timestamp column) is newer than a mark."""
    return df.where(F.col(column) > mark)
