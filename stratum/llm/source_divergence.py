"""How far the sources of a language differ in their use of words.

Terms are counted by (language, source) with map-side combines, then pivoted
into one wide row for each term: an array with the count of each source of the
language, at the source's number.  Higher-order functions turn counts into
smoothed shares (whole billionths) and each row into the absolute differences
of all pairs of sources; these are summed by pair where they arise, so that no
more than a row for each pair leaves a task.

All arithmetic is on whole numbers: products that pass 64 bits are decimals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .support import BROADCAST_ROWS, Scratch, small
from .wordgrams import words

#: Everything but letters A-Z and a-z and what lies beyond ASCII.
NOT_LETTER_CLASS = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: A term is kept if so many documents of its language hold it.
MIN_DOCS = 30
#: Terms that are reported of each group.
TOP_TERMS = 50
#: Added to each count.
SMOOTHING = 5
SCALE = 1_000_000_000


@dataclass(frozen=True)
class Audit:
    """What an audit finds.

    groups: (lang, source, at, n_terms, n_kept), the number of each source in its
    language, the occurrences of kept terms in it, and the kept terms of the language;
    pairs: (lang, source, other, value), a row for each ordered pair;
    terms: (lang, source, term, n, share, lang_share, value, rank), those of the
    highest excess over the language.
    """

    groups: DataFrame
    pairs: DataFrame
    terms: DataFrame


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * kept)), exactly."""
    wide = "decimal(20,0)"
    part = (n + SMOOTHING).cast(wide) * F.lit(SCALE).cast("decimal(10,0)")
    whole = (total + SMOOTHING * kept).cast(wide)
    return F.lit(1).cast("long") + F.call_function("div", part, whole)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and the rows that hold the term."""
    terms = words(F.col("text"), NOT_LETTER_CLASS)
    # All words of a row, then its distinct ones: two lists, told apart by their number.
    lists = docs.select("lang", "source", terms.alias("terms")).select("lang", "source", F.posexplode(F.array("terms", F.array_distinct("terms"))).alias("distinct", "terms"))
    each = lists.select("lang", "source", "distinct", F.explode("terms").alias("term"))
    return each.groupBy("lang", "source", "term").agg(F.sum(F.lit(1) - F.col("distinct")).alias("n"), F.sum("distinct").alias("docs"))


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> Audit:
    """Compare all sources of each language with each other and with the language.

    A row is a document; null text, lang and source are read as ''.  Rows that
    repeat count again.  A group whose texts are empty takes part with counts
    of 0; a language in which no term is kept has pairs of value 0 and no
    terms.  An empty table gives empty results.  Only text, lang and source of
    `docs` are read.  A term's row is as wide as its language has sources.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    numbered = rows.select("lang", "source").distinct().withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    numbered = scratch.keep(numbered, "groups")
    width = small(numbered.groupBy("lang").agg(F.count("*").cast("int").alias("width")))

    counted = term_counts(rows).join(small(numbered), ["lang", "source"])
    entries = F.map_from_entries(F.collect_list(F.struct("at", "n")))
    pivoted = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), entries.alias("by")).where(F.col("docs") >= min_docs).join(width, "lang")
    of_source = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.coalesce(F.try_element_at("by", i), F.lit(0).cast("long")))
    vectors = scratch.keep(pivoted.select("lang", "term", of_source.alias("counts")), "vectors")

    totals = vectors.select("lang", F.posexplode("counts").alias("at", "n")).groupBy("lang", "at").agg(F.sum("n").alias("n_terms"), F.count("*").alias("n_kept"))
    zero = F.lit(0).cast("long")
    groups = numbered.join(totals, ["lang", "at"], "left").select("lang", "source", "at", F.coalesce("n_terms", zero).alias("n_terms"), F.coalesce("n_kept", zero).alias("n_kept"))
    groups = scratch.keep(groups, "totals")
    by_number = F.array_sort(F.collect_list(F.struct("at", "source", "n_terms")))
    langs = groups.groupBy("lang").agg(by_number.alias("g"), F.max("n_kept").alias("n_kept"), F.sum("n_terms").alias("n_lang"))
    langs = scratch.keep(langs.select("lang", F.col("g.source").alias("sources"), F.col("g.n_terms").alias("totals"), "n_kept", "n_lang"), "langs")
    # The arrays of all languages together have an entry for each group: `small` groups make a small table.
    of_lang = F.broadcast(langs) if groups.count() <= BROADCAST_ROWS else langs

    shares = F.transform("counts", lambda n, i: _share(n, F.get("totals", i), F.col("n_kept")))
    lang_share = _share(F.aggregate("counts", zero, lambda a, b: a + b), F.col("n_lang"), F.col("n_kept"))
    shared = scratch.keep(vectors.join(of_lang, "lang").select("lang", "term", "counts", shares.alias("shares"), lang_share.alias("lang_share")), "shares")
    scratch.drop(vectors)

    # One source of a term at a time with all later ones, so that a row grows with the sources, not with their pairs.
    first = shared.select("lang", "shares", F.posexplode("shares").alias("a", "share"))
    later = F.slice("shares", F.col("a") + 2, F.size("shares"))
    apart = F.transform(later, lambda other, j: F.struct((F.col("a") + 1 + j).alias("b"), F.abs(F.col("share") - other).alias("f")))
    sums = first.select("lang", "a", F.explode(apart).alias("x")).groupBy("lang", "a", F.col("x.b").alias("b")).agg(F.sum("x.f").alias("f"))
    both = F.explode(F.array(F.struct(F.col("a").alias("at"), F.col("b").alias("other_at")), F.struct(F.col("b").alias("at"), F.col("a").alias("other_at"))))
    sums = scratch.keep(sums.select("lang", both.alias("x"), "f").select("lang", "x.*", "f"), "pairs")
    listed = groups.join(of_lang.select("lang", "sources"), "lang").select("lang", "source", "at", F.posexplode("sources").alias("other_at", "other")).where("at <> other_at")
    pairs = listed.join(sums, ["lang", "at", "other_at"], "left").select("lang", "source", "other", F.coalesce("f", zero).alias("value"))

    each = shared.select("lang", "term", "lang_share", F.posexplode(F.arrays_zip("counts", "shares")).alias("at", "x")).select("lang", "at", "term", F.col("x.counts").alias("n"), F.col("x.shares").alias("share"), "lang_share")
    above = each.where("n > 0 AND share > lang_share").withColumn("value", F.col("share") - F.col("lang_share"))
    ranked = above.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "at").orderBy(F.desc("value"), "term"))).where(F.col("rank") <= top_terms)
    terms = ranked.join(small(groups).select("lang", "at", "source"), ["lang", "at"]).select("lang", "source", "term", "n", "share", "lang_share", "value", "rank")
    return Audit(groups, pairs, terms)
