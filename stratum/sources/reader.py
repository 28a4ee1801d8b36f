"""State tables as a Spark source, for SQL and for applications that don't run this library's steps.

    spark.dataSource.register(StateSource)
    spark.read.format("stratum_state").option("root", state).option("table", "silver_ig_posts").load()

Each query reads the versions that the state's log names when it is planned, so
a table or view in the catalog stays up to date.  A task reads a bucket, its
latest run first; where a query asks for keys, only their buckets are planned,
for which a session must have set `spark.sql.python.filterPushdown.enabled`.
Files are opened by Arrow.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from ..schemas import OLD_TABLES, TABLES
from .files import arrow_file_system
from .state import BUCKET, level

FORMAT = "stratum_state"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
_BATCH_ROWS = 20_000


def key_hash(values: tuple, kinds: tuple[T.DataType, ...]) -> int | None:
    """Spark's xxhash64 of a key, without the sign; None for types that aren't known here."""
    import xxhash

    found = 42
    for value, kind in zip(values, kinds, strict=True):
        if isinstance(kind, T.StringType) and isinstance(value, str):
            raw = value.encode()
        elif isinstance(kind, T.IntegerType | T.LongType) and isinstance(value, int):
            raw = value.to_bytes(4 if isinstance(kind, T.IntegerType) else 8, "little", signed=True)
        else:
            return None
        found = xxhash.xxh64_intdigest(raw, seed=found)
    return found


def bucket_number(hashed: int, first: int, buckets: int) -> int:
    """The bucket of a key, as `state.bucket_of` has it."""
    low = level(first, buckets)
    signed = hashed - (1 << 64) if hashed >= 1 << 63 else hashed
    return signed % (2 * low) if signed % (2 * low) < buckets else signed % low


class _Bucket(InputPartition):
    def __init__(self, number: int, folders: list[str]):
        super().__init__(number)
        self.folders = folders


def _text(path: str) -> str | None:
    fs, inner = arrow_file_system(path)
    try:
        with fs.open_input_file(inner) as file:
            return file.read().decode()
    except FileNotFoundError:
        return None


def _names(path: str, suffix: str) -> list[str]:
    """Files of a folder by name; none if it isn't there."""
    from pyarrow import fs as arrow_fs

    fs, inner = arrow_file_system(path)
    found = fs.get_file_info(arrow_fs.FileSelector(inner, allow_not_found=True))
    return sorted(f.base_name for f in found if f.is_file and f.base_name.endswith(suffix) and not f.base_name.startswith((".", "_")))


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.root, self.table = schema, options["root"].rstrip("/"), options["table"]
        self.keys = (TABLES | OLD_TABLES)[self.table][1]
        self.wanted: list[tuple] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Remember the keys that are asked for; Spark applies all filters again."""
        asked: dict[str, tuple] = {}
        for f in filters:
            if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in self.keys:
                asked[f.attribute[0]] = (f.value,) if isinstance(f, EqualTo) else tuple(f.value)
        if len(self.keys) == 1 and self.keys[0] in asked:
            self.wanted = [(v,) for v in asked[self.keys[0]]]
        elif len(asked) == len(self.keys) and all(len(v) == 1 for v in asked.values()):
            self.wanted = [tuple(asked[k][0] for k in self.keys)]
        yield from filters

    def partitions(self) -> list[InputPartition]:
        entries = _names(f"{self.root}/_log", ".json")
        version = json.loads(_text(f"{self.root}/_log/{entries[-1]}") or "{}").get(self.table) if entries else None
        version = int(_text(f"{self.root}/{self.table}/_CURRENT") or 0) if version is None else version
        if not version:
            return [_Bucket(-1, [])]
        manifest = json.loads(_text(f"{self.root}/{self.table}/_manifest-{version}") or "")
        kinds = tuple(self.schema[k].dataType for k in self.keys)
        hashes = None if self.wanted is None else [key_hash(v, kinds) for v in self.wanted]
        only = None if hashes is None or None in hashes else {bucket_number(h, manifest["first"], manifest["buckets"]) for h in hashes}
        folders = {int(b): [f"{self.root}/{self.table}/_v={r['folder']}/{BUCKET}={b}" for r in runs] for b, runs in manifest["runs"].items()}
        return [_Bucket(b, own) for b, own in sorted(folders.items()) if only is None or b in only] or [_Bucket(-1, [])]

    def read(self, partition: _Bucket) -> Iterator[pa.RecordBatch]:
        from pyarrow import parquet
        from pyspark.sql.pandas.types import to_arrow_schema

        want = to_arrow_schema(self.schema)
        seen: set[tuple] = set()  # keys of delta runs, which are folded before they outgrow the base
        for number, folder in reversed(list(enumerate(partition.folders))):
            own: set[tuple] = set()
            for name in _names(folder, ".parquet"):
                fs, inner = arrow_file_system(f"{folder}/{name}")
                with fs.open_input_file(inner) as file:
                    stored = parquet.ParquetFile(file)
                    have = set(stored.schema_arrow.names)
                    for part in stored.iter_batches(batch_size=_BATCH_ROWS, columns=[c for c in want.names if c in have]):
                        columns = [part.column(f.name).cast(f.type) if f.name in have else pa.nulls(len(part), f.type) for f in want]
                        batch = pa.RecordBatch.from_arrays(columns, schema=want)
                        if seen or number:
                            keys = list(zip(*(batch.column(k).to_pylist() for k in self.keys), strict=True))
                            own.update(keys if number else ())
                            batch = batch.filter(pa.array([k not in seen for k in keys]))
                        yield batch
            seen |= own


class StateSource(DataSource):
    """Options: `root`, the folder of the state, and `table`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return (TABLES | OLD_TABLES)[self.options["table"]][0]

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, dict(self.options))


def register(spark: SparkSession, state_root: str, tables: tuple[str, ...] = tuple(TABLES), prefix: str = "") -> None:
    """Views `<prefix><name>` in the session's catalog over the tables of a state.

    Spark hands the options of a catalog table to its schema only, not to its
    scans; so a view gives them to each scan.
    """
    spark.dataSource.register(StateSource)
    spark.conf.set(PUSHDOWN, "true")
    for table in tables:
        source = f"{prefix}{table}_source"
        spark.sql(f"DROP TABLE IF EXISTS {source}")
        spark.sql(f"CREATE TABLE {source} USING {FORMAT} OPTIONS (`root` '{state_root}', `table` '{table}')")
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{table} AS SELECT * FROM {source} WITH (`root` = '{state_root}', `table` = '{table}')")
