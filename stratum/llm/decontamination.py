"""Benchmark decontamination: short test items inside long documents.

Containment search with MinHash sketches (the smallest hash values of a set)
in partitions by size.

1. Items are partitioned by the number n of their distinct shingles, from each
   power of two to the next.  An item's sketch is its n - ceil(0.75 n) + 1
   smallest hash values; a document that contains 0.75 of the item's shingles
   holds at least one of those, however long it is.
2. Each partition has a threshold, the largest value in its sketches, and a
   least number of shingles that a document needs to contain one of its items.
   A document's sketch for a partition is the hash values of its shingles up to
   the threshold, and a document that is too short has none.
3. Sketches are joined by (partition, hash value), so the candidates are
   complete.  A second step reads only candidate documents and counts common
   shingles by their text.

DataFrame operations only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .support import Scratch
from .wordgrams import gram_hash, positions, words

WORDS = 5
NUMERATOR, DENOMINATOR = 75, 100
#: Sketch entries and item shingles that may be broadcast; a larger benchmark is joined by a shuffle.
BROADCAST_SHINGLES = 1_000_000
#: Candidate documents whose ids may be broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000


def _needed(n: Column) -> Column:
    """ceil(0.75 n) in integers."""
    return F.floor((n * NUMERATOR + DENOMINATOR - 1) / DENOMINATOR)


def _bounded(df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= limit else df


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, k, shingle, n): distinct shingles of each item, n of them.

    k is WORDS, or the number of words of a shorter item, which is one
    shingle.  Null and empty items have none.  Rows that repeat an item id
    count as one item with the shingles of all of them.
    """
    tokens = items.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text").cast("string")).alias("words"))
    tokens = tokens.where("item_id IS NOT NULL AND size(words) > 0")
    whole = tokens.where(F.size("words") < WORDS).select("item_id", F.size("words").alias("k"), F.array_join("words", " ").alias("shingle"))
    runs = positions(tokens, WORDS, "item_id").select("item_id", F.lit(WORDS).alias("k"), F.array_join(F.slice("words", F.col("at") + 1, WORDS), " ").alias("shingle"))
    distinct = whole.unionByName(runs).distinct()
    sizes = distinct.groupBy("item_id").agg(F.count("*").alias("n"))
    return distinct.join(sizes, "item_id")


def sketches(shingles: DataFrame) -> DataFrame:
    """(item_id, k, part, needed, h): the smallest hash values of each item, its partition by size, and the shingles that a document needs."""
    hashed = shingles.select("item_id", "k", "n", _shingle_hash(F.col("shingle")).alias("h"))
    lists = hashed.groupBy("item_id", "k", "n").agg(F.sort_array(F.collect_set("h")).alias("hs"))
    length = (F.col("n") - _needed(F.col("n")) + 1).cast("int")
    part = F.floor(F.log2("n")).cast("int").alias("part")
    return lists.select("item_id", "k", part, _needed(F.col("n")).alias("needed"), F.explode(F.slice("hs", F.lit(1), length)).alias("h"))


def document_sketches(tokens: DataFrame, k: int, parts: list[Row]) -> DataFrame:
    """(doc_id, part, h) of documents (doc_id, words): their hash values up to the threshold of each partition that they are long enough for."""
    hashed = positions(tokens, k, "doc_id").select("doc_id", F.size("words").alias("n_words"), gram_hash(F.col("words"), F.col("at"), k).alias("h"))
    fits = [(F.col("h") <= p.threshold) & (F.col("n_words") - k + 1 >= p.needed) for p in parts]
    in_parts = F.array_compact(F.array(*(F.when(fit, F.lit(p.part)) for fit, p in zip(fits, parts, strict=True))))
    return hashed.where(reduce(Column.__or__, fits)).select("doc_id", F.explode(in_parts).alias("part"), "h")


def _shingle_hash(shingle: Column) -> Column:
    parts = F.split(shingle, " ")
    # The hash of one to WORDS word columns; missing ones don't change it.
    return F.xxhash64(*(F.try_element_at(parts, F.lit(i + 1)) for i in range(WORDS)))


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_common, containment) of each item of which a document holds 0.75 or more.

    n_shingles is the item's number of distinct shingles.  Null or empty texts
    hold nothing; rows with a null doc_id or item_id take no part; rows that
    repeat a doc_id count as one document with all their shingles.  Other
    columns of either table are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontamination")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    shingles = scratch.keep(item_shingles(items), "items")
    sketch = scratch.keep(sketches(shingles), "sketches")
    parts: dict[int, list[Row]] = {}  # at most WORDS lengths, and a partition for each power of two
    for r in sketch.groupBy("k", "part").agg(F.max("h").alias("threshold"), F.min("needed").alias("needed")).orderBy("k", "part").collect():
        parts.setdefault(r.k, []).append(r)
    tokens = docs.select("doc_id", words(F.col("text")).alias("words"))
    found: DataFrame | None = None
    for k, of_length in parts.items():
        wanted = sketch.where(F.col("k") == k).select("item_id", "part", "h")
        hits = document_sketches(tokens, k, of_length).join(_bounded(wanted, BROADCAST_SHINGLES), ["part", "h"]).select("doc_id", "item_id").distinct()
        found = hits if found is None else found.union(hits)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, n_shingles long, n_common long, containment double")
    candidates = scratch.keep(found.distinct(), "candidates")
    ids = _bounded(candidates.select("doc_id").distinct(), BROADCAST_IDS)
    texts = docs.join(ids, "doc_id", "left_semi").select("doc_id", words(F.col("text")).alias("words"))
    common: DataFrame | None = None
    for k in parts:
        own = _bounded(shingles.where(F.col("k") == k).select("item_id", "shingle", "n", _shingle_hash(F.col("shingle")).alias("h")), BROADCAST_SHINGLES)
        runs = positions(texts, k, "doc_id").select("doc_id", gram_hash(F.col("words"), F.col("at"), k).alias("h"), F.array_join(F.slice("words", F.col("at") + 1, k), " ").alias("text"))
        same = runs.join(own, "h").where("text = shingle").groupBy("doc_id", "item_id", "n").agg(F.count_distinct("shingle").alias("n_common"))
        common = same if common is None else common.union(same)
    result = common.join(candidates, ["doc_id", "item_id"], "left_semi").groupBy("doc_id", "item_id", "n").agg(F.sum("n_common").alias("n_common"))
    result = result.where(F.col("n_common") * DENOMINATOR >= F.col("n") * NUMERATOR)
    return result.select("doc_id", "item_id", F.col("n").alias("n_shingles"), "n_common", (F.col("n_common") / F.col("n")).alias("containment"))
