"""Phrases of two to four words that stand together more often than their parts do.

1. Blocks of texts are cut into pieces and words; a block is kept as numbers of
   its distinct words, beside a list of these words with their counts.
2. The lists give the count of each word; frequent ones get an id of four bytes.
3. In each block, words of the list become ids (a join on the words, not a
   broadcast); a word without an id breaks a piece.  Each place gives one key of
   fixed width, the ids of four words from there on (zeros behind the end of its
   piece).  Equal keys of a block are counted before they leave it.
4. Keys are partitioned by range and sorted.  Phrases of two, three and four
   words are runs of equal prefixes, so one key serves all three lengths.  Runs
   that end where a batch ends are added up afterwards, as part counts.
5. Candidates are joined to the counts of their parts.

A phrase of MIN_COUNT occurrences has words of as many, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .support import Scratch, bound_batches
from .textarrays import byte_ranges, distinct_ranges, lower_table, separator_table, strings, text_blocks, token_ranges

#: Occurrences of a candidate.
MIN_COUNT = 30
#: Longest phrase, in words; a key has an id of ID_BYTES for each.
LONGEST, ID_BYTES = 4, 4
#: Score of a phrase whose parts never stand apart.
SCALE = 2_000_000
#: A phrase goes if a longer one has this share of its occurrences (in hundredths).
SUBSUMED = 80
#: Phrases that are reported of each language.
TOP = 2000
NO_LANG = "und"

#: What ends a piece, and what separates words inside it.
BREAKS = separator_table(*((ord(c), ord(c)) for c in ".,;:!?"), (0x0A, 0x0D))
_SEPARATORS = BREAKS | separator_table((0x20, 0x20), (0x09, 0x09))
_LOWER = lower_table()
_WIDTH = LONGEST * ID_BYTES


@dataclass(frozen=True)
class Phrases:
    """What is mined.

    totals: (lang, n), all words of a language; words: (lang, word, id, f), frequent words;
    grams: (key, f), every phrase of at least MIN_COUNT occurrences as packed ids;
    top: (lang, rank, phrase, a, l, r, n, score).
    """

    totals: DataFrame
    words: DataFrame
    grams: DataFrame
    top: DataFrame


# --- blocks of word numbers -----------------------------------------------------


def _word_numbers(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(numbers from 1, with a 0 between pieces; starts, ends, language codes and counts of the distinct words)."""
    starts, ends, rows = token_ranges(data, offsets, _SEPARATORS)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(rows))
    example, inverse = distinct_ranges(data, starts, ends, langs[row])
    breaks = np.concatenate(([0], np.cumsum(BREAKS[data])))
    apart = (row[1:] != row[:-1]) | (breaks[starts[1:]] != breaks[ends[:-1]])
    numbers = np.insert(inverse + 1, np.flatnonzero(apart) + 1, 0).astype("<u4")
    return numbers, starts[example], ends[example], langs[row[example]], np.bincount(inverse, minlength=len(example))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block of texts: (block, numbers, words)."""
    part, nth = TaskContext.get().partitionId(), 0
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        codes, names = np.asarray(langs.indices), langs.dictionary
        for first, end, data, offsets in text_blocks(batch.column("text")):
            data = _LOWER[data]
            numbers, starts, ends, kinds, counts = _word_numbers(data, offsets, codes[first:end])
            if not len(starts):
                continue
            fields = [names.take(pa.array(kinds)), strings(data, starts, ends).cast(pa.string()), pa.array(counts, pa.int64())]
            words = pa.ListArray.from_arrays(pa.array([0, len(starts)], pa.int32()), pa.StructArray.from_arrays(fields, ["lang", "word", "n"]))
            yield pa.RecordBatch.from_arrays([pa.array([(part << 32) + nth], pa.int64()), pa.array([numbers.tobytes()]), words], names=["block", "numbers", "words"])
            nth += 1


def _with_ids(words: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows with dense ids from 1: places in the parts of a written table, added up by part."""
    placed = scratch.keep(words.withColumn("place", F.monotonically_increasing_id()), "places")  # part << 33, plus the place in it
    part = F.shiftright("place", 33).alias("part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("size")).orderBy("part").collect()  # a row for each file
    first, rows = 1, []
    for r in sizes:
        rows.append((r.part, first))
        first += r.size
    if first > 1 << 8 * ID_BYTES:
        raise ValueError(f"{first - 1} frequent words don't fit in ids of {ID_BYTES} bytes")
    starts = words.sparkSession.createDataFrame(rows, "part long, first long")
    numbered = placed.join(F.broadcast(starts), part == F.col("part"))
    return numbered.select(*words.columns, (F.col("first") + F.col("place") - F.shiftleft("part", 33)).alias("id"))


# --- keys -----------------------------------------------------------------------


def _binary(ids: np.ndarray) -> pa.BinaryArray:
    """Rows of ids as binary keys, the highest byte first, so that keys sort as their ids do."""
    raw = np.ascontiguousarray(ids.astype(f">u{ID_BYTES}"))
    return pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer((np.arange(len(ids) + 1) * _WIDTH).astype(np.int32)), pa.py_buffer(raw)])


def _block_keys(numbers: np.ndarray, at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of LONGEST ids, sorted; counts) of a block: word number at[i] + 1 has ids[i], all others none."""
    order = np.argsort(ids)
    rank = np.zeros(int(max(numbers.max(initial=0), at.max(initial=-1) + 1)) + 1, dtype=np.uint64)
    rank[at[order] + 1] = np.arange(1, len(ids) + 1)
    of_rank = np.concatenate(([0], ids[order]))
    column = np.concatenate((rank[numbers], np.zeros(LONGEST - 1, dtype=np.uint64)))
    columns = [column[i : i + len(numbers)] for i in range(LONGEST)]
    for i in range(1, LONGEST):
        columns[i] = np.where(columns[i - 1] > 0, columns[i], 0)
    keep = columns[1] > 0  # two words at least
    columns = [c[keep] for c in columns]
    if len(ids) < 1 << 16:  # ranks of two bytes: four fit in one number
        packed = columns[0]
        for c in columns[1:]:
            packed = (packed << np.uint64(16)) | c
        packed, counts = np.unique(packed, return_counts=True)
        ranks = np.stack([(packed >> np.uint64(16 * (LONGEST - 1 - i))) & np.uint64(0xFFFF) for i in range(LONGEST)], axis=1)
    else:
        ranks, counts = np.unique(np.stack(columns, axis=1), axis=0, return_counts=True)
    return of_rank[ranks.astype(np.int64)], counts


def _keys(block: pa.Table, ids: pa.Table) -> pa.Table:
    """Keys and counts of one block, from its numbers and the ids of its frequent words."""
    if not len(ids):
        return pa.table({"key": pa.array([], pa.binary()), "f": pa.array([], pa.int64())})
    keys, counts = _block_keys(np.frombuffer(block.column("numbers")[0].as_py(), dtype="<u4"), np.asarray(ids.column("at")), np.asarray(ids.column("id")))
    return pa.table({"key": _binary(keys), "f": pa.array(counts, pa.int64())})


def _run_lengths(least: int):
    """Sorted (key, f) to runs of equal prefixes: those of `least` occurrences, and whatever stands first or last in a batch."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column("key")
            raw = np.frombuffer(keys.buffers()[2], dtype=np.uint8)[keys.offset * _WIDTH : (keys.offset + len(keys)) * _WIDTH]
            ids, f = raw.view(f">u{ID_BYTES}").reshape(-1, LONGEST).astype(np.int64), np.asarray(batch.column("f"))
            differs = np.zeros(len(ids), dtype=bool)
            differs[0] = True
            for size in range(1, LONGEST + 1):
                differs[1:] |= ids[1:, size - 1] != ids[:-1, size - 1]
                if size < 2:
                    continue
                starts = np.flatnonzero(differs)
                sums = np.add.reduceat(f, starts)
                keep = sums >= least
                keep[[0, -1]] = True
                keep &= ids[starts, size - 1] > 0
                found = ids[starts[keep]]
                found[:, size:] = 0
                yield pa.RecordBatch.from_arrays([_binary(found), pa.array(sums[keep], pa.int64())], names=["key", "f"])

    return runs


def _part(key: Column, first: int, size: int) -> Column:
    """The key of `size` words of a phrase from word `first` (from 0) on."""
    words = F.substring(key, first * ID_BYTES + 1, size * ID_BYTES)
    return words if size == LONGEST else F.concat(words, F.lit(bytes(_WIDTH - size * ID_BYTES)))


def _id_key(number: Column) -> Column:
    """The key of one word."""
    return F.unhex(F.rpad(F.lpad(F.hex(number), 2 * ID_BYTES, "0"), 2 * _WIDTH, "0"))


# --- scores ---------------------------------------------------------------------


def _scored(grams: DataFrame, words: DataFrame) -> DataFrame:
    """(key, size, lang, a, l, r, score): each candidate at its lowest-scoring cut."""
    known = grams.unionByName(words.select(_id_key(F.col("id")).alias("key"), "f"))
    cuts = F.array(*(F.when(F.col("size") == size, F.struct(F.lit(k).alias("k"), _part(F.col("key"), 0, k).alias("first"), _part(F.col("key"), k, size - k).alias("rest"))) for size in range(2, LONGEST + 1) for k in range(1, size)))
    each = grams.select("key", F.col("f").alias("a"), _size().alias("size")).select("key", "a", "size", F.explode(F.array_compact(cuts)).alias("c")).select("key", "a", "size", "c.*")
    # The first cut's first part is a word: its row has the language.
    firsts = grams.select("key", "f", F.lit(None).cast("string").alias("lang")).unionByName(words.select(_id_key(F.col("id")).alias("key"), "f", "lang"))
    both = each.join(firsts.select(F.col("key").alias("first"), F.col("f").alias("l"), "lang"), "first").join(known.select(F.col("key").alias("rest"), F.col("f").alias("r")), "rest")
    wide = "decimal(20,0)"
    score = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * F.col("a").cast(wide), F.col("l").cast(wide) + F.col("r").cast(wide))
    best = both.groupBy("key").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("m"), F.max("lang").alias("lang"), F.max("a").alias("a"), F.max("size").alias("size"))
    return best.select("key", "size", "lang", "a", "m.l", "m.r", "m.score")


def _size() -> Column:
    """Words of a key."""
    empty = F.lit(bytes(ID_BYTES))
    return sum((F.when(F.substring("key", i * ID_BYTES + 1, ID_BYTES) != empty, 1).otherwise(0) for i in range(1, LONGEST)), F.lit(1))


def _subsumed(grams: DataFrame) -> DataFrame:
    """(key): candidates inside a longer one with SUBSUMED hundredths of their occurrences."""
    inner = F.array(*(F.when(F.col("size") == size, _part(F.col("key"), i, n)) for size in range(3, LONGEST + 1) for n in range(2, size) for i in range(size - n + 1)))
    longer = grams.select("key", "f", _size().alias("size")).where("size > 2").select("f", F.explode(F.array_compact(inner)).alias("key")).groupBy("key").agg(F.max("f").alias("longer"))
    return grams.join(longer, "key").where(F.col("longer") * 100 >= F.col("f") * SUBSUMED).select("key")


def mine_phrases(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> Phrases:
    """Candidates of `min_count` occurrences, scored, and the first `top` of each language.

    A null text is empty, a null language is NO_LANG.  Rows that repeat count
    again; an empty table gives empty results.  Only text and lang of `docs`
    are read.  A block's list of words and its numbers are bounded by the bytes
    of a block (or of its one text).
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "collocations", wide=("blocks",))
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"))
    blocks = scratch.keep(rows.mapInArrow(_blocks, "block long, numbers binary, words array<struct<lang: string, word: string, n: long>>"), "blocks")
    listed = blocks.select("block", F.posexplode("words").alias("at", "w")).select("block", "at", "w.lang", "w.word", "w.n")

    totals = scratch.keep(listed.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    frequent = listed.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    words = scratch.keep(_with_ids(frequent, scratch), "words")

    ids = listed.select("block", "at", "lang", "word").join(words.select("lang", "word", "id"), ["lang", "word"]).select(F.col("block").alias("of"), "at", "id")
    # Sorted and streamed by block: lists that Spark collects are objects, of all blocks of a task at once.
    keys = scratch.keep(blocks.select("block", "numbers").groupBy("block").cogroup(ids.groupBy("of")).applyInArrow(_keys, "key binary, f long"), "keys")
    scratch.drop(blocks)
    runs = keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_run_lengths(min_count), "key binary, f long")
    grams = scratch.keep(runs.groupBy("key").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count), "grams")
    scratch.drop(keys)

    scored = scratch.keep(_scored(grams, words).join(_subsumed(grams), "key", "left_anti"), "scored")
    # Ties at the last place are kept until phrases are spelled out, which decide them.
    leading = scored.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).where(F.col("place") <= top)
    leading = scratch.keep(leading, "leading")
    spelled = leading.select("key", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("i")).withColumn("id", F.conv(F.hex(F.substring("key", F.col("i") * ID_BYTES + 1, F.lit(ID_BYTES))), 16, 10).cast("long"))
    spelled = spelled.join(words.select("id", "word"), "id").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w")).select("key", F.array_join("w.word", " ").alias("phrase"))
    ranked = leading.join(spelled, "key").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    found = ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    return Phrases(totals, words, grams, found)
