"""Token ids as files of length-delimited binary records.

Documents are dealt to tasks by ranges of their ids and sorted; each task
encodes its texts and writes record files, one record for each document:

    length of the payload, 8 bytes, little-endian as all numbers
    masked CRC-32C of those 8 bytes, 4 bytes
    payload: doc_id, 8 bytes; flags, 4 bytes (1: doc_id is null); bytes of an id, 4 bytes; the ids
    masked CRC-32C of the payload, 4 bytes

Ids take two bytes if the vocabulary allows it.  Next to each record file lies an
index of fixed-size entries (place, length, number of ids before it in the file,
number of ids), by which records are found in any order without a scan.  A
manifest lists the files of the attempts that succeeded, in the order of the
ids; files of attempts that failed are not in it, and are deleted.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import delete, listing, read_text, write_text
from .checksums import crc32c, masked
from .support import bound_batches
from .textarrays import SPACES, byte_ranges, distinct_ranges, separator_table, strings, text_blocks, token_ranges

DEFAULT_TOKENIZER = "word_bpe_49k.json"
#: A task starts another file beyond so many bytes.
FILE_BYTES = 512 << 20
#: Bytes of records that a reading task takes at once, and that one of its tasks is planned for.
READ_BYTES, SPLIT_BYTES = 8 << 20, 64 << 20
#: Words whose ids a worker remembers until it begins anew, and words that are encoded together.
CACHE_WORDS, JOINED_WORDS = 500_000, 1000
#: Patterns of the pre-tokenizers that are known to drop white space and never to look past it.
SPACE_FREE_PATTERNS = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",)

HEAD, FRAME = 16, 12  # bytes before the ids in a payload, and before a payload
INDEX = np.dtype([("place", "<u8"), ("length", "<u8"), ("start", "<u8"), ("n_tokens", "<u8")])
MANIFEST = "_manifest.json"


class Damaged(ValueError):
    """A file is not what its checksums and lengths say."""


def public_tokenizer(name: str = DEFAULT_TOKENIZER) -> str:
    """Path of a file of the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


# --- ids of texts -------------------------------------------------------------


def _steps(what: dict | None, inner: str) -> list[dict]:
    return [] if what is None else what[inner] if what["type"] == "Sequence" else [what]


def splits_at_signs(spec: dict) -> bool:
    """Whether the pre-tokenizer is a known one, which also cuts between letters and signs."""
    first = (_steps(spec.get("pre_tokenizer"), "pretokenizers") or [{"type": ""}])[0]
    return first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"] and first["pattern"].get("Regex") in SPACE_FREE_PATTERNS


def splits_at_spaces(spec: dict) -> bool:
    """Whether a tokenizer gives a text the ids of its words, one after the other, if cut at ASCII white space.

    True only for the forms that are known to: added tokens without spaces,
    normalizers that work within words, and a pre-tokenizer that drops white space.
    """
    added = all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] and not any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", []))
    normal = all(n["type"] in ("NFC", "NFD", "Lowercase") or n == {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "} for n in _steps(spec.get("normalizer"), "normalizers"))
    first, *rest = _steps(spec.get("pre_tokenizer"), "pretokenizers") or [{"type": ""}]
    drops = first["type"] == "WhitespaceSplit" or splits_at_signs(spec)
    inside = all(p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p["use_regex"] for p in rest)
    return added and normal and drops and inside and spec["model"]["type"] == "BPE" and spec["model"].get("dropout") is None


#: Bytes between which a known pre-tokenizer always cuts: ASCII letters and digits, and signs.
#: The apostrophe begins endings such as 's, and three signs are part of special tokens.
_LETTERS = separator_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
_SIGNS = separator_table(*((b, b) for b in b'!"#$%&()*+,-./:;=?@[\\]^_`{}~'))
#: Words that a known pre-tokenizer leaves whole: letters of ASCII and Latin-1.
_WHOLE = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


def cut_words(data: np.ndarray, offsets: np.ndarray, signs: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row offsets) of words between white space, with `signs` cut between letters and signs, too."""
    starts, ends, rows = token_ranges(data, offsets, SPACES)
    if not signs or not len(starts):
        return starts, ends, rows
    letter, sign = _LETTERS[data], _SIGNS[data]
    cuts = np.flatnonzero(letter[:-1] & sign[1:] | sign[:-1] & letter[1:]) + 1
    first, last = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    first[starts], last[ends - 1] = True, True
    first[cuts], last[cuts - 1] = True, True
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


class Encoder:
    """A tokenizer in a worker: ids of a block of texts, each distinct word encoded once where that gives the same.

    Words of letters only are encoded many at a time: the ids of each end with
    one whose token has the model's suffix of words, by which they are cut
    again.  Ids of words are kept one after the other in an array; a word's
    number in it is remembered.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.tokenizer, told = Tokenizer.from_str(spec), json.loads(spec)
        self.by_word = splits_at_spaces(told)
        self.by_sign = self.by_word and splits_at_signs(told)
        suffix, vocabulary = told["model"].get("end_of_word_suffix"), told["model"]["vocab"]
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.sizes = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of words of letters."""
        ids = np.array(self._ids([" ".join(words)])[0], dtype=np.uint32)
        ends = np.flatnonzero(self.ends[ids]) if len(ids) and int(ids.max()) < len(self.ends) else np.zeros(0, dtype=np.int64)
        return (ids, np.diff(ends, prepend=-1)) if len(ends) == len(words) else self._single(words)

    def _single(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self._ids(words)
        return np.array([i for x in lists for i in x], dtype=np.uint32), np.array([len(x) for x in lists], dtype=np.int64)

    def _numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of words in the array of ids, which may be begun anew."""
        if len(self.known) > CACHE_WORDS:
            self._forget()
        new = [w for w in words if w not in self.known]
        joined = [w for w in new if self.by_sign and _WHOLE.fullmatch(w)]
        rest = [w for w in new if not (self.by_sign and _WHOLE.fullmatch(w))]
        found = [self._joined(joined[i : i + JOINED_WORDS]) for i in range(0, len(joined), JOINED_WORDS)] + [self._single(rest)]
        new = joined + rest
        first = len(self.sizes)
        self.ids, self.sizes = (np.concatenate(x) for x in ((self.ids, *(f[0] for f in found)), (self.sizes, *(f[1] for f in found))))
        self.known.update(zip(new, range(first, first + len(new)), strict=True))
        return np.array([self.known[w] for w in words], dtype=np.int64)

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets into them) of the texts of a block."""
        if not self.by_word:
            lists = self._ids(strings(data, offsets[:-1], offsets[1:]).to_pylist())
            sizes = np.array([len(x) for x in lists], dtype=np.int64)
            return np.array([i for x in lists for i in x], dtype=np.uint32), np.concatenate(([0], np.cumsum(sizes)))
        starts, ends, rows = cut_words(data, offsets, self.by_sign)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
        example, inverse = distinct_ranges(data, starts, ends)
        number = self._numbers(strings(data, starts[example], ends[example]).to_pylist())[inverse]
        sizes = self.sizes[number]
        ids = self.ids[byte_ranges((np.cumsum(self.sizes) - self.sizes)[number], sizes)]
        return ids, np.concatenate(([0], np.cumsum(sizes)))[rows]


_encoders: dict[str, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    if spec not in _encoders:  # once for each Python worker
        _encoders.clear()
        _encoders[spec] = Encoder(spec)
    return _encoders[spec]


# --- records ------------------------------------------------------------------


def frame(doc_ids: np.ndarray, missing: np.ndarray, ids: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the records, lengths of their payloads); `missing` marks documents without an id."""
    unit = np.dtype(f"<u{width}")
    counts = np.diff(bounds)
    lengths = HEAD + counts * width
    places = np.concatenate(([0], np.cumsum(FRAME + lengths + 4)))
    out = np.zeros(int(places[-1]), dtype=np.uint8)
    at = places[:-1]

    def put(where: np.ndarray, values: np.ndarray) -> None:
        raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
        out[where[:, None] + np.arange(raw.shape[1])] = raw

    put(at, lengths.astype("<u8"))
    put(at + FRAME, np.where(missing, 0, doc_ids).astype("<i8"))
    put(at + FRAME + 8, missing.astype("<u4"))
    put(at + FRAME + 12, np.full(len(at), width, dtype="<u4"))
    out.view(unit)[byte_ranges((at + FRAME + HEAD) // width, counts)] = ids  # all places are multiples of the width
    put(at + 8, masked(crc32c(out, at, np.full(len(at), 8))).astype("<u4"))
    put(at + FRAME + lengths, masked(crc32c(out, at + FRAME, lengths)).astype("<u4"))
    return out, lengths


def unframe(data: np.ndarray, lengths: np.ndarray, where: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, missing, ids, offsets) of whole records whose payloads have these lengths; raises Damaged."""
    places = np.concatenate(([0], np.cumsum(FRAME + lengths + 4)))
    at = places[:-1]

    def take(begin: np.ndarray, kind: str) -> np.ndarray:
        return data[begin[:, None] + np.arange(np.dtype(kind).itemsize)].view(kind).reshape(-1)

    if len(data) != places[-1] or (lengths < HEAD).any() or not np.array_equal(take(at, "<u8"), lengths.astype("<u8")):
        raise Damaged(f"{where}: lengths differ from the index")
    if not np.array_equal(take(at + 8, "<u4"), masked(crc32c(data, at, np.full(len(at), 8)))):
        raise Damaged(f"{where}: checksum of a length")
    if not np.array_equal(take(at + FRAME + lengths, "<u4"), masked(crc32c(data, at + FRAME, lengths))):
        raise Damaged(f"{where}: checksum of a record")
    widths = take(at + FRAME + 12, "<u4")
    width = int(widths[0]) if len(widths) else 4
    if width not in (2, 4) or (widths != width).any():
        raise Damaged(f"{where}: bytes of an id")
    counts = (lengths - HEAD) // width
    ids = data.view(f"<u{width}")[byte_ranges((at + FRAME + HEAD) // width, counts)].astype(np.uint32)
    return take(at + FRAME, "<i8"), take(at + FRAME + 8, "<u4") != 0, ids, np.concatenate(([0], np.cumsum(counts)))


# --- writing ------------------------------------------------------------------


@dataclass(frozen=True)
class RecordFile:
    """A committed file: its name, the task and the place among the task's files, and what it holds."""

    name: str
    part: int
    nth: int
    records: int
    tokens: int
    bytes: int


@dataclass(frozen=True)
class Manifest:
    """The files of a dataset in the order of their documents."""

    width: int
    end_id: int | None
    files: tuple[RecordFile, ...]


def _file_system(folder: str):
    """(file system, path in it) for a task; schemes are those that Arrow opens."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{os.path.abspath(folder)}" if not folder.startswith("file:") else "file://" + folder[5:])


_MESSAGE = "name string, part int, nth int, records long, tokens long, bytes long"


class _Writer:
    """The files of one task attempt; their names are no other attempt's."""

    def __init__(self, folder: str, part: int, limit: int):
        self.fs, self.path = _file_system(folder)
        self.fs.create_dir(self.path)
        self.part, self.limit, self.done, self.out = part, limit, [], None

    def _open(self) -> None:
        self.name = f"part-{self.part:06d}-{len(self.done):04d}-{uuid.uuid4().hex}"
        self.out, self.index = self.fs.open_output_stream(f"{self.path}/{self.name}.rec"), []
        self.bytes = self.tokens = 0

    def add(self, data: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> None:
        if self.out is None:
            self._open()
        entries = np.zeros(len(lengths), dtype=INDEX)
        sizes = FRAME + lengths + 4
        entries["place"], entries["length"] = self.bytes + np.cumsum(sizes) - sizes, lengths
        entries["start"], entries["n_tokens"] = self.tokens + np.cumsum(counts) - counts, counts
        self.index.append(entries)
        self.out.write(data)
        self.bytes += len(data)
        self.tokens += int(counts.sum())
        if self.bytes >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        entries = np.concatenate(self.index)
        raw = entries.view(np.uint8)
        with self.fs.open_output_stream(f"{self.path}/{self.name}.idx") as out:
            out.write(raw)
            out.write(masked(crc32c(raw, np.zeros(1), np.array([len(raw)]))).astype("<u4").tobytes())
        self.done.append((self.name, self.part, len(self.done), len(entries), self.tokens, self.bytes))
        self.out = None

    def messages(self) -> pa.RecordBatch:
        columns = zip(*self.done, strict=True) if self.done else [[]] * 6
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["name", "part", "nth", "records", "tokens", "bytes"])


def write_token_records(docs: DataFrame, folder: str, tokenizer_path: str | None = None, end_id: int | None = 1, file_bytes: int = FILE_BYTES) -> Manifest:
    """Encode all texts and write them as records by ascending doc_id.

    A null text is an empty one; its record holds the end id only.  Null ids
    come first; rows that repeat an id come one after the other, by a hash of
    their texts, so the rows of one id may be dealt to several tasks (not those
    that repeat the text too, which a task streams).  An empty table gives a
    manifest without files.  Further columns are ignored.  `folder` must be
    shared by driver and executors, in a store that Spark and Arrow both open,
    and hold no other dataset.  The driver receives a row for each file.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    with open(tokenizer_path or public_tokenizer(), encoding="utf-8") as file:
        spec = file.read()
    shared = spark.sparkContext.broadcast(spec)
    highest = max([end_id or 0, *json.loads(spec)["model"]["vocab"].values(), *(t["id"] for t in json.loads(spec).get("added_tokens", []))])
    width = 2 if highest < 1 << 16 else 4

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = _encoder(shared.value), _Writer(folder, TaskContext.get().partitionId(), file_bytes)
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column("text")):
                ids, bounds = encoder.block(data, offsets)
                if end_id is not None:
                    ids = np.insert(ids, bounds[1:], end_id)
                    bounds = bounds + np.arange(len(bounds))
                keys = batch.column("doc_id").slice(first, end - first)
                writer.add(*frame(np.asarray(keys.fill_null(0)), np.asarray(keys.is_null()), ids, bounds, width), np.diff(bounds))
        writer.close()
        yield writer.messages()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tie = F.xxhash64("text")
    messages = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie).mapInArrow(write, _MESSAGE).collect()  # a row for each file
    files = tuple(RecordFile(*m) for m in sorted(messages, key=lambda m: (m.part, m.nth)))
    manifest = Manifest(width, end_id, files)
    names = {f"{f.name}.{kind}" for f in files for kind in ("rec", "idx")}
    for f in listing(spark, folder):
        if f.name.startswith("part-") and f.name not in names:
            delete(spark, f.path)  # of an attempt that failed
    write_text(spark, f"{folder.rstrip('/')}/{MANIFEST}", json.dumps(asdict(manifest)))
    return manifest


# --- reading ------------------------------------------------------------------


def read_manifest(spark: SparkSession, folder: str) -> Manifest:
    text = read_text(spark, f"{folder.rstrip('/')}/{MANIFEST}")
    if text is None:
        raise LookupError(f"{folder} holds no dataset")
    found = json.loads(text)
    return Manifest(found["width"], found["end_id"], tuple(RecordFile(**f) for f in found["files"]))


def _index(fs, path: str, records: int) -> np.ndarray:
    with fs.open_input_file(path) as file:
        raw = np.frombuffer(file.read(), dtype=np.uint8)
    body = raw[:-4]
    if len(raw) != records * INDEX.itemsize + 4 or raw[-4:].tobytes() != masked(crc32c(body, np.zeros(1), np.array([len(body)]))).astype("<u4").tobytes():
        raise Damaged(f"{path}: checksum or size of the index")
    return body.view(INDEX)


_COLUMNS = {"file": "int", "record": "long", "doc_id": "long", "start": "long", "n_tokens": "long", "ids": "array<int>", "ids_crc32": "long"}
_KINDS = {"file": pa.int32(), "record": pa.int64(), "doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64()}


def _batch(columns: tuple[str, ...], numbers: dict[str, np.ndarray], records: tuple) -> pa.RecordBatch:
    """Asked-for columns of unframed records; `numbers` has file, record and start of each."""
    doc_ids, missing, ids, bounds = records
    made = []
    for c in columns:
        if c == "doc_id":
            made.append(pa.array(doc_ids, pa.int64(), mask=missing))
        elif c == "n_tokens":
            made.append(pa.array(np.diff(bounds), pa.int64()))
        elif c == "ids":
            made.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32))))
        elif c == "ids_crc32":
            raw, ends = memoryview(ids.astype("<u4").tobytes()), (bounds * 4).tolist()
            made.append(pa.array([zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.int64()))
        else:
            made.append(pa.array(numbers[c], _KINDS[c]))
    return pa.RecordBatch.from_arrays(made, names=list(columns))


def _runs(entries: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries that lie one after the other in their file, of `limit` bytes or one record each."""
    sizes = (FRAME + 4 + entries["length"]).astype(np.int64)
    ends = entries["place"].astype(np.int64) + sizes
    breaks = np.flatnonzero(entries["place"][1:].astype(np.int64) != ends[:-1]) + 1
    for low, high in zip([0, *breaks.tolist()], [*breaks.tolist(), len(entries)], strict=True):
        while low < high:
            end = max(low + 1, int(np.searchsorted(ends[low:high], int(entries["place"][low]) + limit, side="right")) + low)
            yield low, end
            low = end


def read_token_records(spark: SparkSession, folder: str, columns: tuple[str, ...] = ("file", "record", "doc_id", "start", "n_tokens", "ids")) -> DataFrame:
    """A row for each record, in the order of the files within a task.

    `start` is the number of ids in all records before; `ids_crc32` the CRC-32
    of the ids as little-endian 32-bit numbers.  Damaged files raise.  Files
    are cut into splits of about SPLIT_BYTES by their index.
    """
    manifest = read_manifest(spark, folder)
    before = np.concatenate(([0], np.cumsum([f.tokens for f in manifest.files]))).astype(np.int64)
    splits = [(number, i, n) for number, f in enumerate(manifest.files) for n in [max(1, -(-f.bytes // SPLIT_BYTES))] for i in range(n)]
    schema = ", ".join(f"{c} {_COLUMNS[c]}" for c in columns)
    if not splits:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _file_system(folder)
        for number, i, n in (splits[s] for batch in batches for s in batch.column(0).to_pylist()):
            f = manifest.files[number]
            index = _index(fs, f"{path}/{f.name}.idx", f.records)
            low, high = (int(np.searchsorted(index["place"], f.bytes * k // n, side="left")) for k in (i, i + 1))
            own = index[low:high]
            with fs.open_input_file(f"{path}/{f.name}.rec") as file:
                for a, b in _runs(own, READ_BYTES):
                    size = int((FRAME + 4 + own["length"][a:b]).sum())
                    data = np.frombuffer(file.read_at(size, int(own["place"][a])), dtype=np.uint8)
                    numbers = {"file": np.full(b - a, number), "record": np.arange(low + a, low + b), "start": own["start"][a:b].astype(np.int64) + before[number]}
                    yield _batch(columns, numbers, unframe(data, own["length"][a:b].astype(np.int64), f.name))

    return spark.range(0, len(splits), 1, len(splits)).mapInArrow(read, schema)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """(file, record, place, length, start, n_tokens) of each record, from the indexes alone."""
    manifest = read_manifest(spark, folder)
    schema = "file int, record long, place long, length long, start long, n_tokens long"
    if not manifest.files:
        return spark.createDataFrame([], schema)
    before = np.concatenate(([0], np.cumsum([f.tokens for f in manifest.files]))).astype(np.int64)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _file_system(folder)
        for number in (s for batch in batches for s in batch.column(0).to_pylist()):
            f = manifest.files[number]
            e = _index(fs, f"{path}/{f.name}.idx", f.records)
            arrays = [np.full(len(e), number, np.int32), np.arange(len(e)), *(e[c].astype(np.int64) for c in ("place", "length")), e["start"].astype(np.int64) + before[number], e["n_tokens"].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["file", "record", "place", "length", "start", "n_tokens"])

    return spark.range(0, len(manifest.files), 1, len(manifest.files)).mapInArrow(read, schema)


def shuffled_token_records(spark: SparkSession, folder: str, seed: int, columns: tuple[str, ...] = ("file", "record", "doc_id", "start", "n_tokens", "ids"), partitions: int | None = None) -> DataFrame:
    """All records in an order that `seed` (and the dataset) fixes: index entries are shuffled, records are read by their places.

    Tasks together hold the order, one after the other.  Only entries of the
    index pass the shuffle.
    """
    manifest = read_manifest(spark, folder)
    schema = ", ".join(f"{c} {_COLUMNS[c]}" for c in columns)
    order = [F.xxhash64(F.lit(seed), "file", "record"), F.col("file"), F.col("record")]
    entries = read_index(spark, folder)
    dealt = entries.repartitionByRange(partitions, *order) if partitions else entries.repartitionByRange(*order)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _file_system(folder)
        for batch in batches:
            e = {c: np.asarray(batch.column(c)) for c in batch.schema.names}
            ends = np.cumsum(FRAME + 4 + e["length"])
            low = 0
            while low < len(ends):
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + READ_BYTES, side="right")))
                rows = np.arange(low, high)
                by_place = rows[np.lexsort((e["place"][rows], e["file"][rows]))]  # near places of a file are read in its order
                raw: dict[int, bytes] = {}
                for number in np.unique(e["file"][rows]).tolist():
                    with fs.open_input_file(f"{path}/{manifest.files[number].name}.rec") as file:
                        for r in by_place[e["file"][by_place] == number].tolist():
                            raw[r] = file.read_at(int(FRAME + 4 + e["length"][r]), int(e["place"][r]))
                data = np.frombuffer(b"".join(raw[r] for r in rows.tolist()), dtype=np.uint8)
                yield _batch(columns, {c: e[c][rows] for c in ("file", "record", "start")}, unframe(data, e["length"][rows], folder))
                low = high

    return dealt.sortWithinPartitions(*order).mapInArrow(read, schema)
