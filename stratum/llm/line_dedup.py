"""Line dedup by content-defined chunks of lines.

Every line has a hash, and a rolling minimum over windows of two neighbouring
lines chooses the boundaries (winnowing): of each window the line with the
smaller hash, the first if both are equal.  So two lines in three are
boundaries, whether a line is one depends on its neighbours only, and lines
that are inserted elsewhere shift nothing.  A chunk is a window with its
boundary.  Every passage of two lines or more holds the boundary of each of
its windows, whatever stands around it, so passages of any length from two
lines up are found whole, as runs of chunks that overlap.

1. Boundaries are counted over the corpus.  What stands at a boundary that
   occurs once can't be repeated and goes no further; most lines end here.
2. The chunks at repeated boundaries are counted.  One that stands at several
   places is removed everywhere but at the first, the one with the smallest
   (document id, line number), after its bytes have been compared with the
   first place's.  The first place of each chunk comes before the places that
   lose it, so every line that goes is still held by an earlier one.

Only hashes are shuffled for the search, and texts only for the first places
and for the final rewrite.  Counts are added up before they are shuffled, and
every join by a chunk is one of two written tables, so that Spark splits the
places of a very frequent chunk among tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .support import Scratch, bound_batches
from .textarrays import text_blocks, token_hashes

#: Ids of documents with first places that may be broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000


def line_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row offsets) of all lines; an end includes the line's newline, if it has one."""
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.union1d(offsets[:-1][np.diff(offsets) > 0], breaks[breaks < len(data)])
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return starts, ends, np.searchsorted(starts, offsets)


class Lines:
    """The lines of a block of texts: byte ranges without newlines, hashes, row and number in its row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, ends, self.rows = line_ranges(data, offsets)
        self.ends = ends - (data[np.maximum(ends - 1, 0)] == 10) * (ends > self.starts)  # a last line equals the same line elsewhere
        self.hashes = token_hashes(data, self.starts, self.ends, lower=False)
        self.row = np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))
        self.number = np.arange(len(self.starts)) - self.rows[self.row]

    def chosen(self) -> tuple[np.ndarray, np.ndarray]:
        """(before, after): whether a line is the boundary of the window with the line before it, and with the one after it."""
        inside = self.number[1:] > 0
        before, after = np.zeros((2, len(self.hashes)), dtype=bool)
        after[:-1] = inside & (self.hashes[:-1] <= self.hashes[1:])
        before[1:] = inside & (self.hashes[1:] < self.hashes[:-1])
        return before, after


_BOUNDARIES = "doc_id long, line int, boundary long, before long, after long"


def _boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each boundary, with the hashes of the neighbours that it was chosen over."""
    for batch in batches:
        ids = np.asarray(batch.column("doc_id"))
        for first, _, data, offsets in text_blocks(batch.column("text")):
            lines = Lines(data, offsets)
            before, after = lines.chosen()
            at = np.flatnonzero(before | after)
            hashes = lines.hashes.view(np.int64)
            near = [pa.array(hashes[np.clip(at + step, 0, len(hashes) - 1)], mask=~side[at]) for step, side in ((-1, before), (1, after))]
            columns = [pa.array(ids[first + lines.row[at]]), pa.array(lines.number[at].astype(np.int32)), pa.array(hashes[at]), *near]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "line", "boundary", "before", "after"])


_KEY = ["boundary", "side", "other"]
_BODIES = "boundary long, side int, other long, body binary"


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted chunks of each text; where a text has other lines there, nothing."""
    for batch in batches:
        for first, end, data, offsets in text_blocks(batch.column("text")):
            lines = Lines(data, offsets)
            wanted = batch.column("wanted").slice(first, end - first)
            row = np.repeat(np.arange(end - first), np.asarray(wanted.value_lengths()))
            flat = wanted.flatten()
            line, boundary, side, other = (np.asarray(flat.field(name)) for name in ("line", *_KEY))
            there = lines.rows[row] + line
            ok = there + 1 < lines.rows[row + 1]
            there, boundary, side, other = there[ok], boundary[ok], side[ok], other[ok]
            hashes = lines.hashes.view(np.int64)
            same = (hashes[there + (side == 0)] == boundary) & (hashes[there + (side == 1)] == other)
            there, key = there[same], [pa.array(x[same]) for x in (boundary, side, other)]
            body = [data[a:b].tobytes() for a, b in zip(lines.starts[there].tolist(), lines.ends[there + 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*key, pa.array(body, pa.binary())], names=[*_KEY, "body"])


def _removed(text: bytes, doubtful: list[dict]) -> tuple[bytes, int, int]:
    """(new text, lines removed, chunks removed): chunks go whose bytes equal the given ones."""
    lines = text.split(b"\n")
    tail = lines[-1] == b"" and len(lines) > 1  # a newline at the end, not an empty line
    if tail:
        lines.pop()
    gone: set[int] = set()
    chunks = 0
    for given in doubtful:
        at = given["line"]
        if b"\n".join(lines[at : at + 2]) == given["body"]:
            gone.update((at, at + 1))
            chunks += 1
    kept = [line for i, line in enumerate(lines) if i not in gone]
    return b"\n".join(kept) + b"\n" * (tail and bool(kept)), len(gone), chunks


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop the doubtful chunks; other texts pass as they are."""
    for batch in batches:
        texts = batch.column("text")
        n_lines, removed_lines, removed_chunks = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
        for first, _, data, offsets in text_blocks(texts):
            size = np.diff(offsets)
            newlines = np.concatenate(([0], np.cumsum(data == 10)))
            whole = newlines[offsets[1:]] - newlines[offsets[:-1]]
            n_lines[first : first + len(size)] = whole + ((size > 0) & (data[np.maximum(offsets[1:] - 1, 0)] != 10) if len(data) else 0)
        doubtful = batch.column("doubtful")
        rows = np.flatnonzero(np.asarray(doubtful.is_valid()))
        new: dict[int, str] = {}
        for at in rows.tolist():
            body, removed_lines[at], removed_chunks[at] = _removed(texts[at].as_py().encode(), doubtful[at].as_py())
            if removed_chunks[at]:
                new[at] = body.decode("utf-8")
        if new:
            values = texts.to_pylist()
            for at, value in new.items():
                values[at] = value
            texts = pa.array(values, texts.type)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], texts, pa.array(n_lines), pa.array(removed_lines), pa.array(removed_chunks)], names=[*batch.schema.names[:-2], "text", "n_lines", "n_removed_lines", "n_removed_chunks"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, *carry, text, n_lines, n_removed_lines, n_removed_chunks), one row per input row.

    Null texts stay null and empty ones empty, with no lines.  A document of
    repeated chunks only ends as an empty text; a line that is repeated alone
    stays.  Rows with a null id keep their text.  Rows that repeat an id count
    as one document: a chunk whose first place is at a line of that id stays
    there in all of them.  Columns of `docs` that `carry` doesn't name are
    ignored; those it names may have any names but the ones of the result.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "linededup")
    carried = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), *carried, F.col(text_col).cast("string").alias("text"))
    known = docs.where("doc_id IS NOT NULL").select("doc_id", "text")

    boundaries = scratch.keep(known.mapInArrow(_boundaries, _BOUNDARIES), "boundaries")
    repeated = scratch.keep(boundaries.groupBy("boundary").agg(F.count("*").alias("places")).where("places > 1").select("boundary"), "repeated")
    side = lambda number, other, line: F.struct(F.lit(number).alias("side"), other.alias("other"), line.alias("line"))
    windows = F.array(side(0, F.col("before"), F.col("line") - 1), side(1, F.col("after"), F.col("line")))
    chunks = boundaries.join(repeated, "boundary", "left_semi").select("boundary", "doc_id", F.inline(windows)).where("other IS NOT NULL")
    chunks = scratch.keep(chunks, "chunks")
    scratch.drop(boundaries, repeated)

    first = chunks.groupBy(*_KEY).agg(F.count("*").alias("places"), F.min(F.struct("doc_id", "line")).alias("first")).where("places > 1")
    first = scratch.keep(first.select(*_KEY, F.col("first.doc_id").alias("first_doc"), F.col("first.line").alias("first_line")), "first")
    again = scratch.keep(chunks.join(first, _KEY).where("doc_id <> first_doc OR line <> first_line").select(*_KEY, "doc_id", "line"), "again")
    owners = first.select(F.col("first_doc").alias("doc_id")).distinct()
    if first.count() <= BROADCAST_IDS:
        owners = F.broadcast(owners)
    wanted = first.groupBy(F.col("first_doc").alias("doc_id")).agg(F.collect_list(F.struct(F.col("first_line").alias("line"), *_KEY)).alias("wanted"))
    texts = known.join(owners, "doc_id", "left_semi").join(wanted, "doc_id").select("text", "wanted")
    bodies = scratch.keep(texts.mapInArrow(_bodies, _BODIES).dropDuplicates(_KEY), "bodies")
    doubtful = again.join(bodies, _KEY).groupBy("doc_id").agg(F.collect_set(F.struct("line", "body")).alias("doubtful"))
    doubtful = scratch.keep(doubtful, "doubtful")
    scratch.drop(chunks, first, again, bodies)

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in ("n_lines", "n_removed_lines", "n_removed_chunks"))])
    rewritten = docs.join(doubtful, "doc_id", "left").select(*docs.columns, "doubtful").mapInArrow(_rewrite, schema)
    return rewritten.select("doc_id", *(F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)), "text", "n_lines", "n_removed_lines", "n_removed_chunks")
