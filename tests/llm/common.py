"""Small corpora for the operators, and plain versions of what they compute."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns that a table may carry besides, with names that operators use inside.
CLASHES = ("words", "n", "row", "at", "key", "node", "label", "blk", "train", "items", "h", "spans", "block", "stats", "first", "hub", "score", "lang_", "doubtful", "n_lines")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text: str | None, k: int = 5) -> set[tuple[str, ...]]:
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark: SparkSession, rows: list[tuple], clashes: bool = True) -> DataFrame:
    """Documents of (doc_id, text), with further columns that are null, of clashing names."""
    names = CLASHES if clashes else ()
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in names)
    return spark.createDataFrame([(i, t, None, None, None if t is None else len(t), *(None,) * len(names)) for i, t in rows], schema).repartition(3)


def edge_cases() -> list[tuple]:
    """Null and empty texts, a null id, repeated rows, ties, white space only, few words, and a very long text."""
    long = prose(random.Random(5), 60_000, 5_000)
    return [(1, None), (2, ""), (3, " \t\n "), (4, "Two words"), (5, "two WORDS"), (None, "a null id has a text of its own here"), (6, "one two three four five six seven"), (6, "one two three four five six seven"), (7, long), (8, "ünïcode Ärger ▁ \U0001f600 ende")]
