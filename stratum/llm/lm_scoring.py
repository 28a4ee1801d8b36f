"""Language-model scores from a log-frequency Bloom filter.

1. One pass over the texts turns them into blocks: the distinct word hashes of
   a few megabytes of text, and the texts as codes into them.
2. Exact word counts: a row for each block and distinct word, with its count
   in training texts, is summed by word and joined back to the blocks.
3. Bigrams of the training texts are counted exactly and then kept as a
   log-frequency Bloom filter: a bigram of quantised count q is entered q
   times, as (bigram, 1) to (bigram, q).  A bucket's entries have a part of the
   filter of their own, sized for them, so that the rate of false positives is
   the same at any size.
4. The filter is cut into segments of at most MAX_BROADCAST bytes, and the
   distinct bigrams of each block are written once, dealt by segment.  Workers
   get one segment after the other as a broadcast and probe that segment's
   bigrams only, so all passes together read each bigram once, however many
   segments there are.  A bigram's level is read by probing (bigram, 1),
   (bigram, 2) and so on until a probe fails.
5. Levels and word counts are joined to the blocks, which gives the scores.  A
   level stands for its smallest count, which can't exceed the exact counts of
   the bigram's words.  The model is the mean of len(WEIGHTS) interpolated
   models, P(text) = mean over weights of the product of
   P(w | h) = u * c(h w) / r(h) + (1 - u) * P(w), u = weight * c(h) / r(h),
   with P(w) of the base.  The room r(h) is c(h) and what false positives add to
   the counts of h's followers among all words of the vocabulary, taken from the
   filter's set bits as expected plus four standard deviations; so P(w | h) adds
   up to 1 at most over the vocabulary.  Histories that are rare beside their
   false followers thus fall back to the base.  The first level, on which the
   number of false followers depends, has more probes than the others.

Words are told apart by 64-bit hashes, bigrams by 56 bits, and in the filter by
their bucket and 32 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .support import Scratch, bound_batches, shuffle_partitions
from .textarrays import SPACES, mix, text_blocks, token_hashes, token_ranges

#: Bytes of text in a block.
BLOCK_BYTES = 3_000_000
#: Distinct hashes that one reduce group holds, about.
ENTRIES_PER_BUCKET = 1_000_000
#: Bytes of the Arrow batches of bigrams by bucket: more than the entries of a bucket.
BUCKET_BATCH_BYTES = 16 << 20
#: Counts are quantised to thresholds that grow by this factor.
LOG_BASE = 1.25
LEVELS = 120
#: Probes of a bigram's first level and of each further one, and filter bits for each: rates of false positives of about 0.06 and 0.9 %.
FIRST_PROBES, PROBES = 8, 5
BITS_PER_PROBE = 2
#: Bytes of the filter that are broadcast, and that the driver holds, at once.
MAX_BROADCAST = 64_000_000
#: Weights of the bigrams in the interpolation.
WEIGHTS = (0.0, 0.05, 0.2, 0.5, 0.9, 0.99)

_U = np.uint64
_END, _START = _U(0x0E4D), _U(0x57A7)


def thresholds() -> np.ndarray:
    """Smallest count of each level: 1, 2, 3, ..., later by LOG_BASE."""
    out = [1]
    while len(out) < LEVELS:
        out.append(max(out[-1] + 1, int(out[-1] * LOG_BASE)))
    return np.array(out, dtype=np.float64)


def level_values() -> np.ndarray:
    """Count that a level stands for (level 0: none): the smallest."""
    return np.concatenate(([0.0], thresholds()))


def probes(level: int) -> int:
    return FIRST_PROBES if level == 1 else PROBES


def room(c_before: np.ndarray, v: int, rates: tuple[float, float]) -> np.ndarray:
    """Count of a history with what false positives may add to those of its followers, out of v words.

    `rates` are those of the first level, and of a further one.  The number of
    strangers that pass is about Poisson; a follower, or a stranger that has
    passed, gains one more level, no more than its own count, at the second rate.
    """
    first, further = rates[0], rates[1] / (1 - rates[1])
    strangers = first * v
    return (c_before + strangers + 4 * np.sqrt(strangers)) * (1 + further)


def conditional(weight: float, joint: np.ndarray, c_before: np.ndarray, word: np.ndarray, r: np.ndarray) -> np.ndarray:
    """P(w | h) / P(w) of one weight."""
    u = weight * c_before / np.maximum(r, 1e-300)
    return u * joint / np.maximum(r, 1e-300) / word + (1 - u)


def bigram_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """56-bit hashes, in the upper bits."""
    return mix(mix(left) * _U(0x9E3779B97F4A7C15) + right) & ~_U(0xFF)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


# --- blocks ---------------------------------------------------------------

_BLOCK = "block long, ids array<long>, train array<boolean>, bounds array<int>, words array<long>, codes array<int>"
_BLOCK_NAMES = ["block", "ids", "train", "bounds", "words", "codes"]


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for first, end, data, offsets in text_blocks(batch.column("text"), BLOCK_BYTES):
            starts, ends, bounds = token_ranges(data, offsets, SPACES)
            words, codes = np.unique(token_hashes(data, starts, ends), return_inverse=True)
            rows = batch.slice(first, end - first)
            columns = [rows.column("doc_id"), rows.column("train"), pa.array(bounds.astype(np.int32)), pa.array(words.view(np.int64)), pa.array(codes.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array([number]), *map(_one_list, columns)], names=_BLOCK_NAMES)
            number += 1


class Block:
    """A row of the table of blocks as arrays."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        column = lambda name: batch.column(name)[row].values
        self.number = batch.column("block")[row].as_py()
        self.ids = column("ids")
        self.train = np.asarray(column("train")).astype(bool)
        self.bounds = np.asarray(column("bounds")).astype(np.int64)
        self.words = np.asarray(column("words")).astype(np.int64).view(_U)
        self.codes = np.asarray(column("codes"))
        self.n_words = np.diff(self.bounds)

    def sequence(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(codes of tokens, codes of the tokens before, row starts): an end after each text, a start before it.

        The end has the code len(words), the start len(words) + 1.
        """
        starts = self.bounds[:-1] + np.arange(len(self.n_words))
        ends = starts + self.n_words
        tokens = np.empty(len(self.codes) + len(starts), dtype=np.int64)
        inner = np.ones(len(tokens), dtype=bool)
        inner[ends] = False
        tokens[inner] = self.codes
        tokens[ends] = len(self.words)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[starts] = len(self.words) + 1
        return tokens, before, starts

    def hashes(self) -> np.ndarray:
        return np.concatenate((self.words, [_END, _START]))

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of the distinct bigrams, ascending, and which of them each token ends)."""
        tokens, before, _ = self.sequence()
        hashes = self.hashes()
        return np.unique(bigram_hashes(hashes[before], hashes[tokens]), return_inverse=True)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Block]]:
    for batch in batches:
        for row in range(len(batch)):
            yield batch, row, Block(batch, row)


# --- exact word counts ----------------------------------------------------


def _split(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, offsets) of ascending bucket numbers."""
    if not len(bucket):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    at = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1))
    return bucket[at], np.append(at, len(bucket))


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block and distinct word: its place in the block, and its count in training texts."""
    for _, _, block in _each(batches):
        trained = np.repeat(block.train, block.n_words)
        counts = np.bincount(block.codes[trained], minlength=len(block.words)).astype(np.int64)
        columns = [np.full(len(counts), block.number), np.arange(len(counts), dtype=np.int32), block.words.view(np.int64), counts]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "at", "word", "n"])


def _in_places(table: pa.Table) -> pa.Table:
    """The totals of the words of one block, by their places."""
    counted = np.zeros(len(table), dtype=np.int64)
    counted[np.asarray(table.column("at"))] = np.asarray(table.column("total"))
    return pa.table({"block": table.column("block").slice(0, 1).combine_chunks(), "counted": _one_list(pa.array(counted))})


# --- the filter -----------------------------------------------------------


def _bigrams(buckets: int):
    """Map function: counted bigrams of training texts by bucket, as 56 bits of hash and 8 of count."""

    def pack(hashes: np.ndarray) -> pa.RecordBatch:
        values, counts = np.unique(hashes, return_counts=True)
        parts = [values | np.minimum(counts, 255).astype(_U)]
        while (counts := counts - 255).max(initial=0) > 0:  # a count above 255 takes several entries
            more = counts > 0
            values, counts = values[more], counts[more]
            parts.append(values | np.minimum(counts, 255).astype(_U))
        entries = np.sort(np.concatenate(parts))
        of, offsets = _split(bucket_of(entries, buckets))
        return pa.RecordBatch.from_arrays([pa.array(of.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(entries.view(np.int64)))], names=["bucket", "entries"])

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for _, _, block in _each(batches):
            tokens, before, _ = block.sequence()
            trained = np.repeat(block.train, block.n_words + 1)
            hashes = block.hashes()
            held.append(bigram_hashes(hashes[before[trained]], hashes[tokens[trained]]))
            if sum(map(len, held)) >= 1_500_000:
                yield pack(np.concatenate(held))
                held = []
        if held:
            yield pack(np.concatenate(held))

    return bigrams


def filter_keys(hashes: np.ndarray) -> np.ndarray:
    """32 bits of bigram hashes, which tell apart the bigrams of a bucket."""
    return (hashes >> _U(8)).astype(np.uint32)


def double_hash(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Probe i of entry (hash, level) is the bit ((one + i * two) >> 11) modulo the size of the part."""
    one = mix((hashes << _U(8)) + _U(level))
    return one, mix(one ^ _U(0xD6E8FEB86659FD93)) | _U(1)


def _build(table: pa.Table) -> pa.Table:
    """The part of the filter for one bucket of bigrams."""
    entries = np.concatenate([np.asarray(x.values) for x in table.column("entries")]).view(_U)
    hashes, inverse = np.unique(entries & ~_U(0xFF), return_inverse=True)
    counts = np.bincount(inverse, weights=(entries & _U(0xFF)).astype(np.float64))
    levels = np.searchsorted(thresholds(), counts, side="right")
    size = max(64, BITS_PER_PROBE * (FIRST_PROBES * len(levels) + PROBES * int((levels - 1).sum())))
    bits = np.zeros(size, dtype=bool)
    keys = filter_keys(hashes).astype(_U)
    for level in range(1, int(levels.max(initial=0)) + 1):
        one, two = double_hash(keys[levels >= level], level)
        for i in range(probes(level)):
            bits[(((one + _U(i) * two) >> _U(11)) % _U(size)).astype(np.int64)] = True
    return pa.table({"bucket": table.column("bucket").slice(0, 1).combine_chunks(), "size": pa.array([size]), "n_set": pa.array([int(bits.sum())]), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})


class Segment:
    """Parts of the filter for the buckets first to last, one after the other."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes.astype(_U), bits
        self.offsets = np.concatenate(([0], np.cumsum(((sizes + 7) // 8) * 8))).astype(_U)

    def levels(self, bucket: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Levels of the bigrams of these keys in these buckets (counted from the segment's first), by probing level after level."""
        keys = keys.astype(_U)
        levels = np.zeros(len(keys), dtype=np.uint8)
        left = np.flatnonzero(self.sizes[bucket] > _U(0)) if len(keys) else np.zeros(0, np.int64)
        for level in range(1, LEVELS + 1):
            size, offset = self.sizes[bucket[left]], self.offsets[bucket[left]]
            one, two = double_hash(keys[left], level)
            for i in range(probes(level)):
                at = offset + (((one + _U(i) * two) >> _U(11)) % size)
                hit = (self.bits[(at >> _U(3)).astype(np.int64)] >> (_U(7) - (at & _U(7))).astype(np.uint8)) & 1
                keep = hit.astype(bool)
                left, one, two, size, offset = left[keep], one[keep], two[keep], size[keep], offset[keep]
                if not len(left):
                    return levels
            levels[left] = level
        return levels


class Filter:
    """The written parts of the filter, and the buckets at which its segments begin."""

    def __init__(self, parts: DataFrame, buckets: int):
        self.parts, self.buckets = parts, buckets
        self.sizes, share = np.zeros(buckets, dtype=np.int64), np.zeros(buckets)
        for r in parts.select("bucket", "size", "n_set").toLocalIterator():  # two numbers for each ENTRIES_PER_BUCKET bigrams
            self.sizes[r.bucket], share[r.bucket] = r.size, r.n_set / r.size
        #: False-positive rates of a bigram's first level and of a further one.
        self.rates = (float((share**FIRST_PROBES).mean()), float((share**PROBES).mean()))
        firsts, held = [0], 0
        for bucket, size in enumerate(((self.sizes + 7) // 8).tolist()):
            if held and held + size > MAX_BROADCAST:
                firsts.append(bucket)
                held = 0
            held += size
        self.firsts = np.array(firsts)

    def segments(self) -> Iterator[Segment]:
        """One after the other; each has at most MAX_BROADCAST bytes, or one part if that is larger."""
        for first, end in zip(self.firsts.tolist(), [*self.firsts.tolist()[1:], self.buckets], strict=True):
            own = self.sizes[first:end]
            offsets = np.concatenate(([0], np.cumsum((own + 7) // 8)))
            bits = np.zeros(max(1, int(offsets[-1])), dtype=np.uint8)
            for r in self.parts.where(f"bucket >= {first} AND bucket < {end}").toLocalIterator():
                part = np.frombuffer(r.bits, dtype=np.uint8)
                bits[offsets[r.bucket - first] : offsets[r.bucket - first] + len(part)] = part
            yield Segment(own, bits)


def _questions(firsts: np.ndarray, buckets: int):
    """Map function: the distinct bigrams of each block by segment, ascending: how many of each bucket, and their keys."""
    ends = np.append(firsts[1:], buckets)

    def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, block in _each(batches):
            bigrams = block.bigrams()[0]
            of, keys = bucket_of(bigrams, buckets), filter_keys(bigrams)
            segments, offsets = _split(np.searchsorted(firsts, of, side="right") - 1)
            counts, asked = [], []
            for segment, a, b in zip(segments.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                counts.append(np.bincount(of[a:b] - firsts[segment], minlength=ends[segment] - firsts[segment]).astype(np.int32).tobytes())
                asked.append(keys[a:b].tobytes())
            columns = [pa.array(segments.astype(np.int32)), pa.array(np.full(len(segments), block.number)), pa.array(counts, pa.binary()), pa.array(asked, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["segment", "block", "counts", "keys"])

    return questions


def _prober(shared):
    """Map function: levels of the asked bigrams of a segment."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = shared.value
        for batch in batches:
            levels = []
            for counts, keys in zip(batch.column("counts"), batch.column("keys"), strict=True):
                sizes = np.frombuffer(counts.as_buffer(), dtype=np.int32)
                levels.append(segment.levels(np.repeat(np.arange(len(sizes)), sizes), np.frombuffer(keys.as_buffer(), dtype=np.uint32)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("segment"), pa.array(levels, pa.binary())], names=["block", "segment", "levels"])

    return probe


# --- scores ---------------------------------------------------------------

_SCORED = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType()))])


def _scorer(n: int, v: int, texts: int, rates: tuple[float, float]):
    """Map function: base scores, and the model's log10 probabilities."""
    values = level_values()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, block in _each(batches):
            tokens, before, starts = block.sequence()
            counts = np.full(len(block.words) + 2, texts, dtype=np.float64)
            if len(block.words):
                counts[:-2] = np.asarray(batch.column("counted")[row].values)
            c_word, c_before = counts[tokens], counts[before]
            word = (c_word + 0.5) / (n + 0.5 * (v + 1))
            base = np.log10(word)
            levels = np.frombuffer(b"".join(x["levels"].as_py() for x in batch.column("levels")[row].values), dtype=np.uint8)
            joint = np.minimum(values[levels[block.bigrams()[1]]], np.minimum(c_word, c_before))
            r = room(c_before, v, rates)
            n_known, base_score = (np.add.reduceat(x, starts) for x in ((c_word > 0).astype(np.int64), base))
            parts = np.stack([np.add.reduceat(base + np.log10(conditional(weight, joint, c_before, word, r)), starts) for weight in WEIGHTS])
            best = parts.max(axis=0)
            mean = best + np.log10((10.0 ** (parts - best)).sum(axis=0) / len(WEIGHTS))
            yield pa.RecordBatch.from_arrays([block.ids, *map(pa.array, (block.n_words + 1, n_known, base_score, mean))], names=[f.name for f in _SCORED.fields])

    return score


def score_texts(docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of each row.

    `may_learn` is a condition on the columns of `docs`; a row for which it is
    null is not learned from.  A null or empty text has one token, its end.
    Null ids and repeated rows are scored (and learned from) like others.
    Other columns of `docs` are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "lmscoring", wide=("blocks", "counted", "filter", "asked", "levels"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(may_learn, F.lit(False)).alias("train"))
    blocks = scratch.keep(rows.mapInArrow(_blocks, _BLOCK), "blocks")
    sums = blocks.agg(F.count("*").alias("blocks"), F.sum(F.size("codes") + F.size("ids")).alias("tokens"), F.sum(F.size(F.filter("train", lambda x: x))).alias("texts")).first()
    texts = sums.texts or 0

    of_blocks = blocks.mapInArrow(_block_words, "block long, at int, word long, n long")
    counts = scratch.keep(of_blocks.groupBy("word").agg(F.sum("n").alias("total")).where("total > 0"), "counts")
    total = counts.agg(F.sum("total").alias("n"), F.count("*").alias("v")).first()
    n, v = (total.n or 0) + texts, total.v + (texts > 0)
    counted = of_blocks.select("block", "at", "word").join(counts, "word", "left").select("block", "at", F.coalesce("total", F.lit(0)).alias("total"))
    # Sorted and streamed by block: lists that Spark collects are objects, of all blocks of a task at once.
    counted = scratch.keep(counted.groupBy("block").applyInArrow(_in_places, "block long, counted array<long>"), "counted")
    scratch.drop(counts)

    bound_batches(spark, BUCKET_BATCH_BYTES)
    buckets = max(shuffle_partitions(spark), (sums.tokens or 0) // ENTRIES_PER_BUCKET)
    pairs = blocks.mapInArrow(_bigrams(buckets), "bucket int, entries array<long>")
    parts = scratch.keep(pairs.groupBy("bucket").applyInArrow(_build, "bucket int, size long, n_set long, bits binary"), "filter")
    bound_batches(spark)

    bloom = Filter(parts, buckets)
    asked = blocks.mapInArrow(_questions(bloom.firsts, buckets), "segment int, block long, counts binary, keys binary")
    asked = scratch.keep(asked.repartition("segment", F.pmod("block", F.lit(shuffle_partitions(spark)))), "asked", by="segment")
    levels: DataFrame | None = None
    for number, segment in enumerate(bloom.segments()):
        shared = spark.sparkContext.broadcast(segment)
        own = asked.where(F.col("segment") == number).mapInArrow(_prober(shared), "block long, segment int, levels binary")
        levels = scratch.keep(own, "levels") if levels is None else scratch.add(own, levels)
        shared.destroy()
    scratch.drop(parts, asked)

    by_block = levels.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("segment", "levels"))).alias("levels"))
    joined = blocks.repartition(max(shuffle_partitions(spark), sums.blocks // 2), "block").join(counted, "block", "left").join(by_block, "block").select(*_BLOCK_NAMES, "counted", "levels")
    scored = scratch.keep(joined.mapInArrow(_scorer(n, v, texts, bloom.rates), _SCORED), "scores")
    scratch.drop(blocks, counted, levels)
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
