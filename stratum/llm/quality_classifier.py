"""Quality classifier on random Fourier features of document statistics.

Each text becomes a vector of statistics; random cosines of it approximate a
Gaussian kernel.  Partitions sum their part of the normal equations, the sums
are added up, and ridge regression solves them on the driver (a matrix of
fixed size).  The rows are dealt to FOLDS folds whose sums are kept apart, so
that each fold gets scores from the weights of the other folds; isotonic
regression over these scores, in bins, turns a ridge score into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .line_dedup import line_ranges
from .support import Scratch, bound_batches
from .textarrays import SPACES, text_blocks, token_hashes, token_ranges

#: Random cosines; the normal equations have (COSINES + 1) squared entries.
COSINES = 256
#: Width of the Gaussian kernel over standardised statistics.
WIDTH = 6.0
RIDGE = 1.0
SEED = 7
#: Labelled rows that the fit uses at most (a hash of the id picks them).
MAX_TRAIN_ROWS = 400_000
#: Partial sums that reach the driver at most, of 8 * FOLDS * (COSINES + 2) ** 2 bytes each.
MAX_PARTIALS = 24
#: Folds for the calibration; equal statistics are in one fold.
FOLDS = 4
#: Bins of the raw score in which isotonic regression pools.
BINS = 1000
KEEP_AT = 0.7

def _table(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters)] = True
    return table


#: Classes of ASCII characters: punctuation of sentences, and all other punctuation.
_SENTENCE = _table(b".,;:?!'\"()-")
_SYMBOL = _table(bytes(c for c in range(33, 127) if not chr(c).isalnum())) & ~_SENTENCE


def _rows_sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _rows_max(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        out[full] = np.maximum.reduceat(values, bounds[:-1][full])
    return out


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of statistics of each text of a block (see textarrays.text_blocks)."""
    size = np.diff(offsets).astype(np.float64)
    per_byte = np.maximum(size, 1)
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    digit = (data >= 48) & (data <= 57)
    symbol, sentence = _SYMBOL[data], _SENTENCE[data]
    wide = (data & 0xC0) == 0xC0
    marks = np.flatnonzero(symbol | sentence)
    mark_row = np.searchsorted(offsets, marks, side="right") - 1
    commonest_mark = np.bincount(mark_row * 128 + data[marks], minlength=128 * len(size)).reshape(-1, 128).max(axis=1, initial=0)
    columns = [np.log1p(size), *(_rows_sum(x, offsets) / per_byte for x in (upper, lower, digit, symbol, sentence, wide)), commonest_mark / per_byte]

    starts, ends, rows = token_ranges(data, offsets, SPACES)
    n_words = np.diff(rows).astype(np.float64)
    per_word = np.maximum(n_words, 1)
    hashes = token_hashes(data, starts, ends)
    length = (ends - starts).astype(np.float64)
    row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    repeat = np.zeros(len(hashes), dtype=bool)
    repeat[1:] = (hashes[1:] == hashes[:-1]) & (row_of[1:] == row_of[:-1])
    order = np.lexsort((hashes, row_of))
    sorted_hashes, sorted_rows = hashes[order], row_of[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (sorted_hashes[1:] != sorted_hashes[:-1]) | (sorted_rows[1:] != sorted_rows[:-1])
    distinct = np.bincount(sorted_rows[new], minlength=len(rows) - 1).astype(np.float64)
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(hashes)))
    commonest = np.zeros(len(rows) - 1)
    np.maximum.at(commonest, sorted_rows[at], runs)
    upper_sums = np.concatenate(([0], np.cumsum(upper)))
    shouted = (upper_sums[ends] - upper_sums[starts] >= 2).astype(np.float64)
    ends_in = [table[data[ends - 1]] if len(ends) else np.zeros(0, dtype=bool) for table in (_SYMBOL, _SENTENCE)]
    columns += [np.log1p(n_words), _rows_sum(length, rows) / per_word, np.sqrt(np.maximum(_rows_sum(length**2, rows) / per_word - (_rows_sum(length, rows) / per_word) ** 2, 0)), _rows_max(length, rows) ** 0.5, distinct / per_word, np.log1p(distinct), commonest / per_word, _rows_sum(repeat, rows) / per_word, _rows_sum(shouted, rows) / per_word, *(_rows_sum(x, rows) / per_word for x in ends_in)]

    line_starts, line_ends, lines = line_ranges(data, offsets)
    n_lines = np.diff(lines).astype(np.float64)
    per_line = np.maximum(n_lines, 1)
    line_size = np.maximum(line_ends - line_starts, 1)
    line_row = np.repeat(np.arange(len(lines) - 1), np.diff(lines))
    long_line = line_size >= 30

    def worst(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags)))
        share = (sums[line_ends] - sums[line_starts]) / line_size
        return _rows_max(np.where(long_line, share, 0.0), lines)

    line_hashes = token_hashes(data, line_starts, line_ends)
    line_order = np.lexsort((line_hashes, line_row))
    same = np.zeros(len(line_hashes), dtype=bool)
    a, b = line_order[1:], line_order[:-1]
    same[a] = (line_hashes[a] == line_hashes[b]) & (line_row[a] == line_row[b])
    words_before = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    repeat_sums = np.concatenate(([0], np.cumsum(repeat)))
    line_words = words_before[1] - words_before[0]
    line_repeats = (repeat_sums[words_before[1]] - repeat_sums[words_before[0]]) / np.maximum(line_words, 1)
    columns += [np.log1p(n_lines), size / per_line / 100, _rows_sum(same * line_size, lines) / per_byte, worst(upper), worst(symbol), worst(sentence), _rows_max(np.where(line_words >= 5, line_repeats, 0.0), lines), _rows_max(line_words.astype(np.float64), lines) ** 0.5]
    return np.column_stack(columns)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks = [statistics(data, offsets) for _, _, data, offsets in text_blocks(batch.column("text"))]
        stats = np.concatenate(blocks) if blocks else np.zeros((0, 1))
        bounds = pa.array(np.arange(len(stats) + 1, dtype=np.int32) * stats.shape[1])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(bounds, pa.array(stats.reshape(-1)))], names=["doc_id", "stats"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats array<double>) of (doc_id, text); a null text counts as empty."""
    return docs.select("doc_id", "text").mapInArrow(_features, "doc_id long, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


@dataclass(frozen=True)
class Model:
    """Standardisation, ridge weights and the calibration's steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    score_at: np.ndarray
    probability: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return _cosines(stats, self.mean, self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.score_at, self.probability)


def _cosines(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    random = np.random.default_rng(SEED)
    directions = random.standard_normal((stats.shape[1], COSINES)) / WIDTH
    shifts = random.uniform(0, 2 * np.pi, COSINES)
    x = np.clip((stats - mean) / scale, -8, 8)
    return np.column_stack((np.sqrt(2 / COSINES) * np.cos(x @ directions + shifts), np.ones(len(x))))


def pool_adjacent(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Isotonic regression: the non-decreasing sequence nearest to `values`."""
    blocks: list[list[float]] = []
    for value, weight in zip(values.tolist(), weights.tolist(), strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u = blocks[-1]
            blocks[-1] = [(u[0] * u[1] + v * w) / (u[1] + w), u[1] + w, u[2] + n]
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


def fit(train: DataFrame) -> Model | None:
    """Model of (stats, y) rows with y 0 or 1; None without rows."""
    moments = train.select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("scale"), F.count("*").alias("n")).orderBy("i").collect()
    if not moments:
        return None
    mean = np.array([r["mean"] for r in moments])
    scale = np.array([max(r["scale"], 1e-9) for r in moments])

    shape = (FOLDS, COSINES + 2, COSINES + 2)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            z = np.column_stack((_cosines(_matrix(batch.column("stats")), mean, scale), np.asarray(batch.column("y"), dtype=np.float64))) if len(batch) else np.zeros((0, shape[1]))
            fold = np.asarray(batch.column("fold"))
            for k in range(FOLDS):
                own = z[fold == k]
                total[k] += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    rows = train.select("stats", "y", F.pmod(F.xxhash64("stats"), F.lit(FOLDS)).cast("int").alias("fold"))
    total = np.zeros(shape)
    for row in rows.coalesce(MAX_PARTIALS).mapInArrow(sums, "total binary").toLocalIterator():
        total += np.frombuffer(row.total).reshape(shape)

    def solved(sums: np.ndarray) -> np.ndarray:
        return np.linalg.solve(sums[:-1, :-1] + RIDGE * np.eye(len(sums) - 1), sums[:-1, -1])

    weights = solved(total.sum(axis=0))
    of_others = [solved(total.sum(axis=0) - own) for own in total]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                fold = np.asarray(batch.column("fold"))
                raw = (_cosines(_matrix(batch.column("stats")), mean, scale) * np.array(of_others)[fold]).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int32)), pa.array(raw), batch.column("y").cast(pa.float64())], names=["bin", "raw", "y"])

    bins = rows.mapInArrow(binned, "bin int, raw double, y double").groupBy("bin").agg(F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()
    score_at = np.array([b.raw for b in bins])
    probability = pool_adjacent(np.array([b.y for b in bins]), np.array([b.n for b in bins], dtype=np.float64))
    return Model(mean, scale, weights, score_at, np.clip(probability, 0, 1))


def classify(docs: DataFrame, labels: DataFrame, may_learn: Column, label_col: str = "quality", carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, *carry, text, score, predicted) for each row of docs (doc_id, text).

    `may_learn` is a condition on doc_id; labels of other rows are never read.
    At most about MAX_TRAIN_ROWS labelled rows are learned from, which bounds
    the broadcast of their ids.  A null text is scored as an empty one, and a
    null id like any other row, but without a label.  Null labels are left out
    of the fit, and an id with several labels counts with each.  Without any
    label to learn from, every score is 0.5.  Columns of either table that are
    not named in `carry` are ignored; those named may have any names but the
    ones of the result.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "quality")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where(may_learn & F.col("y").isin(0, 1))
    total = known.count()
    if total > MAX_TRAIN_ROWS:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * MAX_TRAIN_ROWS / total)))
    known = scratch.keep(known, "labels")
    labelled = document_statistics(texts.join(F.broadcast(known.select("doc_id").distinct()), "doc_id", "left_semi"))
    train = scratch.keep(labelled.join(F.broadcast(known), "doc_id").select("stats", "y"), "train")
    model = fit(train)
    names = ["doc_id", *(f"carry_{i}" for i in range(len(carry))), "text"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column("text")):
                score = model.score(statistics(data, offsets)) if model else np.full(end - first, 0.5)
                rows = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(score, pa.float64()), pa.array((score >= KEEP_AT).astype(np.int32))], names=[*names, "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)), F.col("text").cast("string").alias("text"))
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(scored, schema).select("doc_id", *(F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)), "text", "score", "predicted")
