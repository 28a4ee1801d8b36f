"""Paths through Hadoop's file systems, so that any store Spark reads will do."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class File:
    path: str
    name: str
    modified_ms: int
    size: int
    is_dir: bool

    @property
    def stem(self) -> str:
        return self.name.rsplit(".", 1)[0]


def file_system(spark: SparkSession, path: str):
    """(FileSystem, Path) of a path."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


@lru_cache(maxsize=8)
def _arrow_store(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)[0]


def arrow_file_system(path: str):
    """(Arrow's file system, path in it), for tasks, which have no JVM at hand.  Arrow opens file, hdfs, viewfs, s3, gs and abfs."""
    if "://" not in path:
        return _arrow_store("file:///"), "/" + path.removeprefix("file:").lstrip("/")
    scheme, rest = path.split("://", 1)
    scheme, (host, _, inner) = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme), rest.partition("/")
    store = _arrow_store(f"{scheme}://{host}/")
    return store, f"{host}/{inner}" if scheme in ("s3", "gs", "abfs", "abfss") else f"/{inner}"


#: Schemes of object stores on which a rename copies, so that it is neither atomic nor exclusive.
COPYING_SCHEMES = frozenset(("s3", "s3a", "s3n", "gs", "wasb", "wasbs", "oss", "cosn", "obs", "swift"))


def require_atomic_rename(path: str) -> None:
    """Raise ValueError for a folder in an object store: versions and locks need renames that are atomic."""
    scheme = path.split("://", 1)[0].lower() if "://" in path else ""
    if scheme in COPYING_SCHEMES:
        raise ValueError(f"{path}: state needs a file system with atomic renames, such as HDFS; data to read and results may lie in an object store")


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, as listings and scans name it."""
    fs, p = file_system(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def written(spark: SparkSession, path: str) -> bool:
    """Whether a dataset is there as a whole: a file, or a folder that Spark's writer has marked as complete."""
    fs, p = file_system(spark, path)
    return fs.exists(p) and (not fs.getFileStatus(p).isDirectory() or exists(spark, f"{path.rstrip('/')}/_SUCCESS"))


def listing(spark: SparkSession, folder: str) -> list[File]:
    """What lies in a folder, by name; nothing if it isn't there."""
    fs, p = file_system(spark, folder)
    if not fs.exists(p):
        return []
    found = [File(s.getPath().toString(), s.getPath().getName(), s.getModificationTime(), s.getLen(), s.isDirectory()) for s in fs.listStatus(p)]
    return sorted(found, key=lambda f: f.name)


_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Reads that begin inside list their folders by a few tasks for each core; else each of many folders gets a task."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; None if it isn't there."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file: written aside, then renamed over it."""
    fs, aside = file_system(spark, path + ".new")
    stream = fs.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark.sparkContext._jvm
    _, final = file_system(spark, path)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(aside, final, options)


def publish_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear as a whole, written aside and renamed; False if one of its name is there."""
    from py4j.protocol import Py4JJavaError

    aside = f"{path}.{uuid.uuid4().hex}.new"
    fs, p = file_system(spark, aside)
    stream = fs.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark.sparkContext._jvm
    final = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(final).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(p), fs.makeQualified(final), options)
        return True
    except Py4JJavaError:
        delete(spark, aside)
        if fs.exists(final):
            return False
        raise


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False if it is there."""
    from py4j.protocol import Py4JJavaError

    fs, p = file_system(spark, path)
    try:
        stream = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Make a folder that goes when the application ends."""
    fs, p = file_system(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)

