"""License scan by diagonal voting.

All rolling word k-grams of the texts are joined by hash to the positions of
the templates' k-grams.  A hit votes for the diagonal (text position minus
template position); votes are counted by diagonal, neighbouring diagonals,
between which words were inserted or left out, are merged, and a merged span
is accepted if it covers enough of its template.  Hits count only if their
words are equal, not just the hashes.

There are three classes of templates with grams of their own: phrases (2-grams,
to be covered whole on one diagonal), notices of a sentence (3-grams), and whole
licence texts (5-grams), in which lines may have been added or left out.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .support import Scratch
from .wordgrams import NOT_ALNUM_CLASS, words


@dataclass(frozen=True)
class Template:
    label: str
    text: str


#: The phrases and labels that a scan reports as its base.
BASE_PHRASES = (
    Template("gpl", "gnu general public license"),
    Template("apache", "apache license"),
    Template("cc-by", "cc by"),
    Template("mit", "mit license"),
)

#: Notices by which works name a public licence, in words.
NOTICES = (
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("mit-notice", "released under the mit license"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)

def license_bodies() -> tuple[Template, ...]:
    """Whole texts of public licences, which come with the package."""
    folder = Path(__file__).parent / "licenses"
    return tuple(Template(path.stem, path.read_text(encoding="utf-8")) for path in sorted(folder.glob("*.txt")))


PHRASE_K, NOTICE_K, BODY_K = 2, 3, 5
#: Diagonals this near belong to one span, if their hits are near too: so many words, and one more for each SHIFT_SHARE words of the template.
SHIFT, SHIFT_SHARE = 3, 20
#: Share of a template's k-grams that a span must hold.
COVERAGE = 0.7
#: Grams of templates that may be broadcast; more are joined by a shuffle.
BROADCAST_GRAMS = 200_000


def template_words(template: Template) -> list[str]:
    """Words as the scan takes them from texts."""
    lower = template.text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def _grams(spark: SparkSession, templates: Sequence[Template], k: int) -> DataFrame:
    """(h, hits array<struct<template, pos, gram>>), one row for each hash."""
    rows = [(number, i, tokens[i : i + k]) for number, t in enumerate(templates) for tokens in [template_words(t)] for i in range(len(tokens) - k + 1)]
    grams = spark.createDataFrame(rows, "template int, pos int, gram array<string>")
    h = F.xxhash64(*(F.col("gram")[i] for i in range(k)))
    found = grams.groupBy(h.alias("h")).agg(F.collect_list(F.struct("template", "pos", "gram")).alias("hits"))
    return F.broadcast(found) if len(rows) <= BROADCAST_GRAMS else found


def _facts(spark: SparkSession, classes: dict[int, Sequence[Template]]) -> DataFrame:
    """(k, template, label, size): the number of grams of each template; a row each, to be broadcast."""
    rows = [(k, i, t.label, len(template_words(t)) - k + 1) for k, templates in classes.items() for i, t in enumerate(templates)]
    return F.broadcast(spark.createDataFrame(rows, "k int, template int, label string, size int"))


def scan_licenses(docs: DataFrame, phrases: Sequence[Template] = BASE_PHRASES, notices: Sequence[Template] = NOTICES, bodies: Sequence[Template] | None = None) -> DataFrame:
    """One row per input row: (doc_id, n_words, phrase_starts array<struct<start, label>>, spans array<struct<start, label, length, coverage>>).

    Both arrays are sorted.  Null and empty texts have no words, and null ids
    and repeated rows are results of their own.  `bodies` are by default the
    licence texts of the package.  Templates shorter than their class's grams
    find nothing.  Other columns of `docs` are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "licenses")
    classes = {PHRASE_K: phrases, NOTICE_K: notices, BODY_K: license_bodies() if bodies is None else bodies}
    tokens = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text").cast("string"), NOT_ALNUM_CLASS).alias("words"))
    # One position past the end carries the number of words, also of empty texts.
    each = tokens.select("row", "doc_id", "words", F.explode(F.sequence(F.lit(0), F.size("words"))).alias("at"))
    hashes = (F.xxhash64(*(F.get("words", F.col("at") + i) for i in range(k))).alias(f"h{k}") for k in classes)
    each = each.select("row", "doc_id", "words", "at", (F.col("at") == F.size("words")).alias("end"), *hashes)
    for k, templates in classes.items():
        each = each.join(_grams(spark, templates, k).withColumnsRenamed({"h": f"h{k}", "hits": f"hits{k}"}), f"h{k}", "left")
    each = each.where(reduce(Column.__or__, (F.col(f"hits{k}").isNotNull() for k in classes), F.col("end")))

    def true_hits(k: int) -> Column:
        """Those of the hits whose words are equal."""
        own = F.slice("words", F.col("at") + 1, k)
        hits = F.filter(F.coalesce(f"hits{k}", F.array().cast("array<struct<template:int,pos:int,gram:array<string>>>")), lambda x: x["gram"] == own)
        return F.transform(hits, lambda x: F.struct(F.lit(k).alias("k"), x["template"].alias("template"), x["pos"].alias("pos")))

    found = scratch.keep(each.select("row", "doc_id", "at", "end", F.concat(*map(true_hits, classes)).alias("hits")), "hits")

    rows = found.where("end").select("row", "doc_id", F.col("at").cast("long").alias("n_words"))
    votes = found.where("NOT end").select("row", "at", F.explode("hits").alias("hit")).select("row", "at", "hit.*", (F.col("at") - F.col("hit.pos")).alias("diagonal"))
    facts, template = _facts(spark, classes), ["k", "template"]

    whole = votes.where(F.col("k") == PHRASE_K).groupBy("row", *template, "diagonal").agg(F.count_distinct("pos").alias("n")).join(facts, template).where("n = size")
    starts = whole.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.col("diagonal").cast("long").alias("start"), "label"))).alias("phrase_starts"))

    diagonals = votes.where(F.col("k") != PHRASE_K).groupBy("row", *template, "diagonal").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.collect_set("pos").alias("covered")).join(facts, template)
    in_order = Window.partitionBy("row", *template).orderBy("diagonal", "low")
    shift = F.lit(SHIFT) + F.floor(F.col("size") / SHIFT_SHARE)
    far = (F.col("diagonal") - F.lag("diagonal").over(in_order) > shift) | (F.col("low") - F.lag("high").over(in_order) > F.col("size") + shift)
    merged = diagonals.withColumn("span", F.sum(F.coalesce(far, F.lit(True)).cast("int")).over(in_order))
    merged = merged.groupBy("row", *template, "label", "size", "span").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("n"))
    accepted = merged.withColumn("coverage", F.col("n") / F.col("size")).where(F.col("coverage") >= COVERAGE)
    spans = accepted.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.col("low").cast("long").alias("start"), "label", (F.col("high") - F.col("low") + F.col("k")).cast("long").alias("length"), "coverage"))).alias("spans"))

    out = rows.join(starts, "row", "left").join(spans, "row", "left")
    none_starts = F.array().cast("array<struct<start:bigint,label:string>>")
    none_spans = F.array().cast("array<struct<start:bigint,label:string,length:bigint,coverage:double>>")
    return out.select("doc_id", "n_words", F.coalesce("phrase_starts", none_starts).alias("phrase_starts"), F.coalesce("spans", none_spans).alias("spans"))
