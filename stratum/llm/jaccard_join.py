"""N-gram Jaccard join: exact components of near-duplicate documents.

The method skips along set relations.  An inverted list holds the sets that
share a prefix shingle, and the position at which each has it.  From a position
follows the reach of a member: the largest set that it can still be similar to
if this is their first common shingle.  Blocks of list members are skipped whose
sizes and reaches rule each other out.  And a set's answers are derived from
those of a highly similar set: members of a class share one answer, and between
classes overlaps with one pivot set bound the overlaps of all others.

1. One pass over the texts gives every set's size and fingerprint, and adds
   the shingles up in a table of hashed counts, which grows with the input up
   to a bound.  The table only orders shingles (rare ones first) and tells
   which lists are dealt to several tasks, so it never changes a result.
2. A second pass indexes each distinct set under the first
   n - ceil(0.75 n) + 1 shingles of that order.  Two sets with a similarity
   of 0.75 or more share one of these, and within reach at the first they
   share.  A member that no other member of its list is within reach of leaves
   the list: blocks of doubling length, each with its largest reach, are
   skipped as a whole.
3. Each list names its smallest fingerprint as hub.  A set is compared with
   the hub that most of its lists name, and links make classes.  In a group of
   thousands of near copies a set meets its hub, and at most OFFERS members of
   the group if the hub was too far.  Lists that hold one class are skipped.
4. Lists in which more than one class is left are opened.  Their sets are cut
   into blocks by size; two blocks of a list meet if the reach of each is at
   least the smallest size of the other.  Within two blocks, pairs of different
   classes are candidates if their first common shingle is within reach and
   they share as many prefix shingles as similar sets of their sizes must.
   Their overlaps with a pivot set decide most candidates, and the others are
   compared.

Every pair that could link is in one class before step 4 or a candidate in it,
so components are exact.  Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .support import GROUP_BATCH_BYTES, Scratch, bound_batches, components, shuffle_partitions, small
from .textarrays import SPACES, mix, shingle_hashes, text_blocks, token_hashes, token_ranges

WORDS = 5
#: Similarity as a fraction, compared without rounding: 100 * common >= 75 * union.
NUMERATOR, DENOMINATOR = 75, 100
#: Bits of the number of cells of the table of hashed counts (4 bytes each), at least and at most.
SKETCH_BITS = (14, 22)
SKETCH_CHUNKS = 64
#: Postings that one reduce group holds, about.
POSTINGS_PER_BUCKET = 1_000_000
#: A shingle of which the table counts more sets has a list that is dealt to several tasks.
HOT_POSTINGS = 250_000
#: Postings, or items of sets, that a task holds before it hands them on.
HELD_POSTINGS = 400_000
#: Members of the largest class that a set outside it meets before all that fit.
OFFERS = 8
#: Shingles and sets of a block, about: pairs between two blocks are found and compared together.
BLOCK_SHINGLES, BLOCK_NODES = 40_000, 512
#: Members that are compared with one copy of a hub's set.
MEMBERS_PER_TASK = 512

_U = np.uint64


def prefix_length(n):
    """Shingles of which a set of n must share one with any similar set."""
    return n - (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR + 1


def reach(n, position):
    """Size of the largest set that a set of n can be similar to, if their first common shingle is its one at `position`."""
    return (NUMERATOR + DENOMINATOR) * (n - position) // NUMERATOR - n


def document_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    for first, _, data, offsets in text_blocks(texts):
        starts, ends, rows = token_ranges(data, offsets, SPACES)
        hashes, bounds = shingle_hashes(token_hashes(data, starts, ends), rows, WORDS)
        for i in range(len(bounds) - 1):
            yield first + i, np.unique(hashes[bounds[i] : bounds[i + 1]])


def fingerprint(values: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums over a set, as signed integers."""
    one = np.add.reduce(mix(values), dtype=_U)
    two = np.bitwise_xor.reduce(mix(values * _U(0xD6E8FEB86659FD93)), dtype=_U) if len(values) else _U(0)
    return int(one.view(np.int64)), int(two.view(np.int64))


_SURVEY = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("n", T.LongType()), ("fp", T.LongType()), ("fp2", T.LongType()), ("chunk", T.IntegerType()), ("counts", T.BinaryType()))])


def _surveyor(bits: int):
    """Map function: sizes and fingerprints of all sets, and at last the task's counts of the shingles of its distinct sets."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("fp", pa.int64()), ("fp2", pa.int64()), ("chunk", pa.int32()), ("counts", pa.binary())])
    cells = 1 << bits

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(cells, dtype=np.int32), set()

        def add(pending: list[np.ndarray]) -> None:
            if pending:
                np.add(counts, np.bincount(np.concatenate(pending), minlength=cells), out=counts, casting="unsafe")

        for batch in batches:
            sizes, ones, twos, pending, held = [], [], [], [], 0
            for _, values in document_sets(batch.column("text")):
                one, two = fingerprint(values)
                sizes.append(len(values))
                ones.append(one)
                twos.append(two)
                if len(values) and one not in seen:
                    seen.add(one)
                    pending.append((values & _U(cells - 1)).astype(np.int32))
                    held += len(values)
                    if held >= max(HELD_POSTINGS, cells):
                        add(pending)
                        pending, held = [], 0
            add(pending)
            nothing = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ones, pa.int64()), pa.array(twos, pa.int64()), nothing.cast(pa.int32()), nothing.cast(pa.binary())], schema=schema)
        if counts.any():
            parts = np.minimum(counts, 65535).astype(np.uint16).reshape(SKETCH_CHUNKS, -1)
            nothing = pa.nulls(SKETCH_CHUNKS, pa.int64())
            yield pa.RecordBatch.from_arrays([nothing, nothing, nothing, nothing, pa.array(range(SKETCH_CHUNKS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], schema=schema)

    return survey


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
            part = np.frombuffer(counts.as_buffer(), dtype=np.uint16)
            sums[chunk] = sums[chunk] + part if chunk in sums else part.astype(np.int64)
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.minimum(s, 2**31 - 1).astype(np.int32).tobytes() for s in sums.values()], pa.binary())], names=["chunk", "counts"])


def _shared_counts(spark: SparkSession, survey: DataFrame, bits: int):
    """Broadcast of the table of hashed counts: 4 << bits bytes."""
    parts = survey.where("chunk IS NOT NULL").select("chunk", "counts").repartition(SKETCH_CHUNKS, "chunk").mapInArrow(_add_counts, "chunk int, counts binary")
    table = np.zeros((SKETCH_CHUNKS, (1 << bits) // SKETCH_CHUNKS), dtype=np.int32)
    for row in parts.toLocalIterator():
        table[row.chunk] = np.frombuffer(row.counts, dtype=np.int32)
    return spark.sparkContext.broadcast(table.reshape(-1))


def ordered_prefix(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix shingles in the order of their counts, the counts)."""
    counts = table[(values & _U(len(table) - 1)).astype(np.int64)]
    order = np.argsort(counts, kind="stable")[: prefix_length(len(values))]  # values ascend: ties by hash
    return values[order], counts[order]


_POSTING = np.dtype([("key", "<u8"), ("fp", "<i8"), ("n", "<i4"), ("reach", "<i4")])


def _indexer(counts, buckets: int):
    """Map function: packed postings of each distinct set, by bucket; those of hot lists in buckets from `buckets` on."""

    def pack(parts: list[np.ndarray], hot: list[np.ndarray]) -> pa.RecordBatch:
        postings, salts = np.concatenate(parts), np.concatenate(hot)
        part = np.where(salts > 1, postings["fp"].view(_U) % salts.astype(_U), _U(0))
        spread = np.where(salts > 1, mix(postings["key"] + mix(part)), postings["key"])
        bucket = (((spread >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64) + buckets * (salts > 1)
        order = np.argsort(bucket, kind="stable")
        postings, bucket = postings[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        bounds = np.concatenate(([0], cuts, [len(bucket)]))
        return pa.RecordBatch.from_arrays([pa.array(bucket[bounds[:-1]].astype(np.int32)), pa.array([postings[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], names=["bucket", "postings"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = counts.value, set()
        parts, hot, held = [], [], 0
        for batch in batches:
            for _, values in document_sets(batch.column("text")):
                n = len(values)
                if not n or (fp := fingerprint(values)[0]) in seen:
                    continue
                seen.add(fp)
                keys, times = ordered_prefix(values, table)
                posting = np.empty(len(keys), dtype=_POSTING)
                posting["key"], posting["fp"], posting["n"], posting["reach"] = keys, fp, n, reach(n, np.arange(len(keys)))
                parts.append(posting)
                hot.append(times // HOT_POSTINGS + 1)
                held += n
                if held >= 4 * HELD_POSTINGS:
                    yield pack(parts, hot)
                    parts, hot, held = [], [], 0
        if parts:
            yield pack(parts, hot)

    return index


_LISTS = "key long, fp long, n int, reach int, hub long"


def largest_within(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Largest of values[low:high] for each pair of bounds (-1 if there is none), from blocks of doubling length."""
    out = np.full(len(low), -1, dtype=np.int64)
    level = np.full(len(low), -1)
    wide = high > low
    level[wide] = np.log2(high[wide] - low[wide] + 0.5).astype(np.int64)
    for step in range(int(level.max(initial=-1)) + 1):
        own = np.flatnonzero(level == step)
        out[own] = np.maximum(values[low[own]], values[high[own] - (1 << step)])
        values = np.maximum(values[: -(1 << step) or None], values[1 << step :]) if len(values) > 1 << step else values
    return out


def within_reach(key: np.ndarray, n: np.ndarray, reaches: np.ndarray) -> np.ndarray:
    """Whether each member has another one in its list so that each is within the other's reach; sorted by (key, n)."""
    if not len(key):
        return np.zeros(0, dtype=bool)
    number = np.cumsum(np.concatenate(([False], key[1:] != key[:-1]))).astype(np.int64)
    place = number * (1 << 32) + n
    low = np.searchsorted(place, number * (1 << 32) + (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR)
    high = np.searchsorted(place, number * (1 << 32) + reaches, side="right")
    at = np.arange(len(key))
    before = largest_within(reaches, low, np.minimum(high, at))
    after = largest_within(reaches, np.maximum(low, at + 1), high)
    return np.maximum(before, after) >= n


def _lister(buckets: int):
    def lists(table: pa.Table) -> pa.Table:
        """Lists of two sets or more; a member that no other is within reach of is left out, but not from a part of a hot list."""
        postings = np.concatenate([np.frombuffer(x.as_buffer(), dtype=_POSTING) for x in table.column("postings")])
        postings = postings[np.lexsort((postings["fp"], postings["n"], postings["key"]))]
        key, n, fp = postings["key"], postings["n"].astype(np.int64), postings["fp"]
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (fp[1:] != fp[:-1]) | (n[1:] != n[:-1])
        postings = postings[fresh]
        if table.column("bucket")[0].as_py() < buckets:
            postings = postings[within_reach(postings["key"], postings["n"].astype(np.int64), postings["reach"].astype(np.int64))]
        key, fp = postings["key"], postings["fp"]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        hub = np.repeat(np.minimum.reduceat(fp, first), np.diff(np.concatenate((first, [len(key)])))) if len(key) else fp
        return pa.table({"key": pa.array(key.view(np.int64)), "fp": pa.array(fp), "n": pa.array(postings["n"]), "reach": pa.array(postings["reach"]), "hub": pa.array(hub)})

    return lists


def _set_maker(counts):
    """Map function: each set as bytes of its sorted shingles, and its prefix in order, of 32 bits each.

    Equal bits of different shingles can only add candidates.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for batch in batches:
            rows, ones, blobs, prefixes, held = [], [], [], [], 0
            for row, values in document_sets(batch.column("text")):
                rows.append(row)
                ones.append(fingerprint(values)[0])
                blobs.append(values.tobytes())
                prefixes.append(ordered_prefix(values, table)[0].astype(np.uint32).tobytes())
                held += len(values)
                if held >= HELD_POSTINGS or row == len(batch) - 1:
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows)), pa.array(ones, pa.int64()), pa.array(blobs, pa.binary()), pa.array(prefixes, pa.binary())], names=["doc_id", "fp", "items", "prefix"])
                    rows, ones, blobs, prefixes, held = [], [], [], [], 0

    return make


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact test on two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or DENOMINATOR * len(a) < NUMERATOR * len(b):
        return False
    at = np.searchsorted(b, a)
    common = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return DENOMINATOR * common >= NUMERATOR * (len(a) + len(b) - common)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (a, salt), the one with a's own set (b null) first."""
    at, own = None, None
    for batch in batches:
        found_a, found_b = [], []
        for a, salt, b, items in zip(batch.column("a").to_pylist(), batch.column("salt").to_pylist(), batch.column("b").to_pylist(), batch.column("items"), strict=True):
            values = np.frombuffer(items.as_buffer(), dtype=_U)
            if b is None:
                at, own = (a, salt), values.copy()
            elif at == (a, salt) and similar(own, values):
                found_a.append(a)
                found_b.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])


@dataclass(frozen=True)
class Block:
    """Sets of a block as arrays: fingerprints, sizes, labels, and their prefix shingles, sorted, with owner and position.

    `twins` counts the shingles of a set that 32 bits don't tell apart.
    """

    blk: int
    nodes: np.ndarray
    sizes: np.ndarray
    labels: np.ndarray
    keys: np.ndarray
    owners: np.ndarray
    positions: np.ndarray
    twins: np.ndarray

    @classmethod
    def of(cls, blk: int, members: pa.StructArray) -> Block:
        nodes, sizes, labels, prefixes = members.flatten()
        prefixes = [np.frombuffer(x.as_buffer(), dtype=np.uint32) for x in prefixes]
        owners = np.repeat(np.arange(len(nodes)), [len(p) for p in prefixes])
        positions = np.concatenate([np.arange(len(p)) for p in prefixes])
        flat = np.concatenate(prefixes)
        order = np.argsort(flat, kind="stable")
        distinct = np.unique(owners.astype(_U) << _U(32) | flat.astype(_U)) >> _U(32)
        twins = np.array([len(p) for p in prefixes]) - np.bincount(distinct.astype(np.int64), minlength=len(prefixes))
        return cls(blk, np.asarray(nodes), np.asarray(sizes).astype(np.int64), np.asarray(labels), flat[order], owners[order], positions[order], twins)

    def _shared(self, other: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each own set with each of the other block: common prefix shingles, and the first position of one in both."""
        shape = (len(self.nodes), len(other.nodes))
        shared = np.zeros(shape, dtype=np.int32)
        first = [np.full(shape, 1 << 30, dtype=np.int32) for _ in range(2)]
        keys = np.intersect1d(self.keys, other.keys)
        if shape[0] * shape[1] < len(keys):  # by pairs of sets, else by shingles
            for i, j in np.ndindex(shape):
                one, two = self.owners == i, other.owners == j
                common, at, to = np.intersect1d(self.keys[one], other.keys[two], return_indices=True)
                if len(common):
                    shared[i, j], first[0][i, j], first[1][i, j] = len(common), self.positions[one][at].min(), other.positions[two][to].min()
            return shared, *first
        for key in keys:
            # Backwards, so that of the twins of a set the first position is written last.
            one, two = (np.arange(np.searchsorted(x.keys, key), np.searchsorted(x.keys, key, side="right"))[::-1] for x in (self, other))
            at = np.ix_(self.owners[one], other.owners[two])
            shared[at] += 1
            first[0][at] = np.minimum(first[0][at], self.positions[one][:, None])
            first[1][at] = np.minimum(first[1][at], other.positions[two][None, :])
        return shared, *first

    def candidates(self, other: Block) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of nodes of different classes that are within reach and share enough of their prefixes."""
        one, two = self.sizes[:, None], other.sizes[None, :]
        fit = (self.labels[:, None] != other.labels[None, :]) & (DENOMINATOR * np.minimum(one, two) >= NUMERATOR * np.maximum(one, two))
        if not fit.any():
            return self.nodes[:0], other.nodes[:0]
        shared, first_own, first_other = self._shared(other)
        shared += np.minimum(self.twins[:, None], other.twins[None, :])
        needed = -(-NUMERATOR * (one + two) // (NUMERATOR + DENOMINATOR)) + (-NUMERATOR * np.maximum(one, two) // DENOMINATOR) + 1
        fit &= (shared >= np.maximum(needed, 1)) & (two <= reach(one, first_own)) & (one <= reach(two, first_other))
        if self.blk == other.blk:
            fit &= self.nodes[:, None] < other.nodes[None, :]
        rows, columns = np.nonzero(fit)
        return self.nodes[rows], other.nodes[columns]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (blk_a, blk_b, blk, members) come sorted by both blocks: one row for each of the two, or for the only one."""
    at, held = None, {}
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def found() -> pa.RecordBatch:
        pairs = []
        if held and all(blk in held for blk in at):
            left, right = held[at[0]].candidates(held[at[1]])
            pairs = [[{"a": a, "b": b} for a, b in zip(left.tolist(), right.tolist(), strict=True)]] if len(left) else []
        return pa.RecordBatch.from_arrays([pa.array([at[i]] if pairs else [], pa.int64()) for i in (0, 1)] + [pa.array(pairs, kind)], names=["blk_a", "blk_b", "pairs"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("blk_a", "blk_b", "blk")]
        for row, (a, b, blk) in enumerate(zip(*columns, strict=True)):
            if (a, b) != at:
                yield found()
                at, held = (a, b), {}
            held[blk] = Block.of(blk, batch.column("members")[row].values)
    yield found()


def _candidate_pairs(last: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(blk_a, blk_b, pairs) of members (key, fp, n, reach, label, largest) of open lists.

    A set's family is the class that is the largest in most of its lists;
    families are cut by size into blocks of bounded size.  Two blocks that share
    a list meet in one task, unless they hold one class or are out of reach.
    """
    family = last.groupBy("fp", "n", "label", "largest").agg(F.count("*").alias("lists"))
    family = family.groupBy("fp", "n", "label").agg(F.max_by("largest", F.struct("lists", "largest")).alias("family"))
    family = scratch.keep(family.withColumn("size_class", F.floor(F.log("n") * 8)), "families")
    cuts = family.groupBy("family", "size_class").agg(F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK_NODES)).alias("cuts"))
    nodes = family.join(cuts, ["family", "size_class"]).withColumn("blk", F.xxhash64("family", "size_class", F.pmod(F.xxhash64("fp"), F.col("cuts")))).select("blk", "fp", "n", "label")
    nodes = scratch.keep(nodes, "blocks")
    of_list = last.select("key", "fp", "reach").join(nodes, "fp").groupBy("key", "blk")
    of_list = scratch.keep(of_list.agg(F.min("n").alias("least"), F.max("reach").alias("reach"), F.min("label").alias("low"), F.max("label").alias("high")), "block_lists")
    one, two = (of_list.select("key", *(F.col(c).alias(f"{c}_{side}") for c in ("blk", "least", "reach", "low", "high"))) for side in "ab")
    met = one.join(two, "key").where("blk_a <= blk_b AND reach_a >= least_b AND reach_b >= least_a AND NOT (low_a = high_a AND low_b = high_b AND low_a = low_b)")
    met = scratch.keep(met.select("blk_a", "blk_b").distinct(), "block_pairs")
    seats = met.select("blk_a", "blk_b", F.explode(F.array_distinct(F.array("blk_a", "blk_b"))).alias("blk"))
    members = sets.select("fp", "prefix").join(small(nodes), "fp")
    packed = members.groupBy("blk").agg(F.collect_list(F.struct("fp", "n", "label", "prefix")).alias("members"))
    rows = packed.join(seats, "blk").select("blk_a", "blk_b", "blk", "members")
    return rows.repartition("blk_a", "blk_b").sortWithinPartitions("blk_a", "blk_b").mapInArrow(_candidates, "blk_a long, blk_b long, pairs array<struct<a: bigint, b: bigint>>")


def links_among(pairs: list[tuple[int, int]], sets: dict[int, np.ndarray]) -> list[tuple[int, int]]:
    """Links of the pairs that join all that the pairs can join.

    The overlaps of all sets with a pivot, the set in most pairs, are counted
    once.  They bound the overlap of a pair from both sides, which tells most
    answers; other pairs are compared, unless links found before join them.
    """
    if not pairs:
        return []
    a, b = (np.array(x) for x in zip(*pairs, strict=True))
    nodes, times = np.unique(np.concatenate((a, b)), return_counts=True)
    pivot = sets[int(nodes[times.argmax()])]
    own = [sets[int(x)] for x in nodes]
    sizes = np.array([len(x) for x in own])
    flat = np.concatenate(own)
    hit = pivot[np.minimum(np.searchsorted(pivot, flat), len(pivot) - 1)] == flat
    common = np.add.reduceat(hit.astype(np.int64), np.concatenate(([0], np.cumsum(sizes)[:-1])))
    i, j = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    total = sizes[i] + sizes[j]
    least = common[i] + common[j] - len(pivot)
    most = np.minimum(common[j] + sizes[i] - common[i], common[i] + sizes[j] - common[j])
    enough = lambda x: (NUMERATOR + DENOMINATOR) * x >= NUMERATOR * total
    linked = enough(least)
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for at in [*np.flatnonzero(linked).tolist(), *np.flatnonzero(~linked & enough(most)).tolist()]:
        x, y = find(int(i[at])), find(int(j[at]))
        if x != y and (linked[at] or similar(own[i[at]], own[j[at]])):
            root[x] = y
            out.append((int(a[at]), int(b[at])))
    return out


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (blk_a, blk_b, node): the pairs to compare (node null), then a set of each of their nodes."""
    at, wanted, sets = None, [], {}

    def compared() -> pa.RecordBatch:
        found = links_among(wanted, sets)
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    for batch in batches:
        keys = zip(batch.column("blk_a").to_pylist(), batch.column("blk_b").to_pylist(), strict=True)
        nodes = batch.column("node").to_pylist()
        for row, key in enumerate(keys):
            if key != at:
                yield compared()
                at, wanted, sets = key, [], {}
            if nodes[row] is None:
                wanted += [(x["a"], x["b"]) for x in batch.column("pairs")[row].as_py()]
            else:
                sets[nodes[row]] = np.frombuffer(batch.column("items")[row].as_buffer(), dtype=_U).copy()
    yield compared()


def _verified_blocks(packed: DataFrame, sets: DataFrame) -> DataFrame:
    """The similar ones of (blk_a, blk_b, pairs): each set travels once for all pairs between two blocks."""
    both = F.array_union(F.transform("pairs", lambda x: x["a"]), F.transform("pairs", lambda x: x["b"]))
    wanted = small(packed.select("blk_a", "blk_b", F.explode(both).alias("node")))
    none = F.lit(None).cast("array<struct<a: bigint, b: bigint>>")
    held = sets.select(F.col("fp").alias("node"), "items").join(wanted, "node").select("blk_a", "blk_b", "node", "items", none.alias("pairs"))
    asked = packed.select("blk_a", "blk_b", F.lit(None).cast("long").alias("node"), F.lit(None).cast("binary").alias("items"), "pairs")
    rows = held.unionByName(asked).repartition("blk_a", "blk_b").sortWithinPartitions("blk_a", "blk_b", F.col("node").asc_nulls_first())
    return rows.mapInArrow(_compare_blocks, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the (a, b) pairs whose sets are similar.  A busy a is split over several copies of its set."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS_PER_TASK).cast("int").alias("salts"))
    members = pairs.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.col("b").alias("node"), "b")
    owners = salts.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("a").alias("node"), F.lit(None).cast("long").alias("b"))
    rows = sets.select(F.col("fp").alias("node"), "items").join(small(members.unionByName(owners)), "node").select("a", "salt", "b", "items")
    return rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()).mapInArrow(_compare, "a long, b long")


def _likely() -> Column:
    """Whether two sets share half as many lists as similar sets of n_a and n_b shingles share prefix shingles.

    Only for the first comparisons: what it leaves out is found among the candidates.
    """
    common = F.expr(f"ceil({NUMERATOR} * (n_a + n_b) / {NUMERATOR + DENOMINATOR})")
    return 2 * F.col("shared") >= common - F.expr(f"ceil({NUMERATOR} * greatest(n_a, n_b) / {DENOMINATOR})") + 1


def _sizes_fit() -> Column:
    return (DENOMINATOR * F.col("n_a") >= NUMERATOR * F.col("n_b")) & (DENOMINATOR * F.col("n_b") >= NUMERATOR * F.col("n_a"))


def _open_lists(member: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of the lists that hold more than one class, with the list's largest class.

    Both sides of the join are written tables, so that Spark can split a long list.
    """
    member = scratch.keep(member, "members")
    per_class = member.groupBy("key", "label").agg(F.count("*").alias("size"))
    largest = per_class.groupBy("key").agg(F.count("*").alias("classes"), F.max_by("label", F.struct("size", "label")).alias("largest")).where("classes > 1")
    largest = scratch.keep(largest.select("key", "largest"), "largest")
    opened = scratch.keep(member.join(small(largest), "key"), "opened")
    scratch.drop(member, largest)
    return opened


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, n_shingles, component_id).

    component_id is the smallest id that links reach, the own one included.

    Null or empty texts and texts without words have an empty set: n_shingles
    0, linked with nothing, component_id their own id.  A null id gives a null
    component_id and links with nothing.  Repeated rows give repeated results,
    and texts that share an id are linked by their own sets only.  Other columns
    of `docs` are ignored whatever their names.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "jaccard")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max((size // 8).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    survey = scratch.keep(docs.mapInArrow(_surveyor(bits), _SURVEY), "survey")
    base = survey.where("chunk IS NULL").select("doc_id", "n", "fp", "fp2")
    total = base.agg(F.sum("n")).first()[0] or 0
    rows = base.withColumnRenamed("n", "n_shingles")
    # Each set with the smallest id that has it.
    nodes = scratch.keep(base.where("n > 0 AND doc_id IS NOT NULL").groupBy("fp", "fp2", "n").agg(F.min("doc_id").alias("node")), "nodes")
    counts = _shared_counts(spark, survey, bits)
    buckets = max(4 * shuffle_partitions(spark), total // (4 * POSTINGS_PER_BUCKET))
    packed = docs.where("doc_id IS NOT NULL").select("text").mapInArrow(_indexer(counts, buckets), "bucket int, postings binary")
    bound_batches(spark, GROUP_BATCH_BYTES)
    lists = scratch.keep(packed.groupBy("bucket").applyInArrow(_lister(buckets), _LISTS), "lists")
    bound_batches(spark)

    # Each set meets the hub that most of its lists have.  This step and the next may leave out pairs, the last may not.
    star = scratch.keep(lists.groupBy("fp", "n", "hub").agg(F.count("*").alias("shared")), "hubs")
    known = scratch.keep(star.select("fp", "n").distinct(), "known")
    star = star.where("fp <> hub").select(F.col("fp").alias("b"), F.col("n").alias("n_b"), "hub", "shared")
    star = star.join(known.select(F.col("fp").alias("hub"), F.col("n").alias("n_a")), "hub").where(_sizes_fit() & _likely())
    star = scratch.keep(star.groupBy("b").agg(F.max_by("hub", F.struct("shared", "hub")).alias("a")).select("a", "b"), "star")
    involved = small(nodes.join(known, ["fp", "n"], "left_semi").select(F.col("node").alias("doc_id"), "fp"))
    made = docs.join(involved.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_set_maker(counts), "doc_id long, fp long, items binary, prefix binary")
    sets = scratch.keep(made.join(involved, ["doc_id", "fp"], "left_semi").select("fp", "items", "prefix"), "sets")

    def labels_of(links: DataFrame) -> DataFrame:
        return small(scratch.keep(known.join(components(links, scratch), F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("label", "fp").alias("label")), "labels"))

    links = scratch.keep(_verified(star, sets), "links")
    opened = _open_lists(lists.select("key", "fp", "n", "reach").join(labels_of(links), "fp"), scratch)
    # Sets outside a list's largest class meet some of that class first.
    in_largest = F.col("label") == F.col("largest")
    met = opened.where(in_largest).groupBy("key").agg(F.max_by(F.struct("fp", "n"), F.xxhash64("fp")).alias("met")).select("key", F.col("met.fp").alias("a"), F.col("met.n").alias("n_a"))
    outside = opened.where(~in_largest).select("key", F.col("fp").alias("b"), F.col("n").alias("n_b"))
    offers = outside.join(scratch.keep(met, "met"), "key").groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("shared")).where(_sizes_fit() & _likely())
    offers = offers.withColumn("nth", F.row_number().over(Window.partitionBy("b").orderBy(F.desc("shared"), "a"))).where(F.col("nth") <= OFFERS).select("a", "b")
    more = scratch.keep(_verified(scratch.keep(offers, "offers"), sets), "more_links")
    links = scratch.keep(links.union(more).distinct(), "all_links")

    # Candidates among the sets that are left in different classes.
    last = _open_lists(opened.select("key", "fp", "n", "reach").join(labels_of(links), "fp"), scratch)
    pairs = scratch.keep(_candidate_pairs(last, sets, scratch), "pairs")
    more = scratch.keep(_verified_blocks(pairs, sets), "last_links")
    classes = scratch.keep(components(links.union(more), scratch).withColumnRenamed("node", "fp"), "classes")
    scratch.drop(lists, sets, opened, last, pairs)
    labelled = scratch.keep(nodes.join(classes, "fp", "left"), "labelled")
    least = small(scratch.keep(labelled.where("label IS NOT NULL").groupBy("label").agg(F.min("node").alias("component")), "least"))
    found = labelled.join(least, "label", "left").select("fp", "fp2", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component"))
    out = rows.join(scratch.keep(found, "components"), ["fp", "fp2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))
