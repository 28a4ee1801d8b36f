"""Word k-grams of whole texts as DataFrame expressions (no Python in tasks)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import lower_ascii

SPACE_CLASS = "[\\x20\\x09-\\x0D]+"
NOT_ALNUM_CLASS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column, separators: str = SPACE_CLASS) -> Column:
    """Array of the words of a text, A-Z in lower case; null and empty texts have none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), separators), "")


def gram_hash(array: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*(array[at + i] for i in range(k)))


def positions(df: DataFrame, k: int, *keep: str) -> DataFrame:
    """A row (keep..., words, at) for each start of a run of k words.

    The array is not copied: it stays in the generated code's loop, and only
    what later steps keep of a row is ever written.
    """
    enough = df.where(F.size("words") >= k)
    return enough.select(*keep, "words", F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("at"))
