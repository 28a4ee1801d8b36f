"""The corpus pipeline: documents that are fit for training, as token ids.

`STAGES` lists the stages.  Each takes (spark, docs, sf_dir), works on all
that the stage before it kept, and calls one operator of `stratum.llm`.  All
but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.decontamination import contained_items
from stratum.llm.jaccard_join import near_duplicate_components
from stratum.llm.line_dedup import dedup_lines
from stratum.llm.pieces import encode_texts
from stratum.llm.quality_classifier import classify
from stratum.llm.support import Scratch, crc32_mod

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_OTHERS = ("lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score 0.7 or more).

    A null text is judged as an empty one.  Rows are judged one by one: repeated
    rows stay or go together, and rows without an id may stay.  Without labels
    no document is accepted; an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, labels, crc32_mod("doc_id", 4) != 2, carry=_OTHERS).where("predicted = 1").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; documents of which nothing is left go, others get a new n_chars.

    Null and empty texts stay, and so do rows without an id.  Of rows that
    repeat an id and a text none loses lines to another.
    """
    rows = dedup_lines(docs, carry=_OTHERS).where("n_lines = 0 OR n_lines > n_removed_lines OR text IS NULL")
    n_chars = F.when(F.col("n_removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return rows.select("doc_id", "text", "lang", "source", n_chars.cast("long").alias("n_chars"))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component.

    Null and empty texts are near duplicates of nothing.  Of rows that repeat an
    id and a text one stays.  An id with several texts goes only if every one of
    them belongs to a component with a smaller id.  Rows without an id stay.
    """
    found = near_duplicate_components(docs).where("doc_id IS NOT NULL")
    of_id = found.groupBy("doc_id").agg(F.max(F.col("component_id")).alias("component_id"), F.count("*").alias("rows"))
    of_id = Scratch(spark, "near-duplicates").keep(of_id, "components")
    kept = docs.join(of_id.where("doc_id <> component_id").select("doc_id"), "doc_id", "left_anti").select(*COLUMNS)
    repeated = of_id.where("rows > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    return kept.join(repeated, "doc_id", "left_anti").unionByName(kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])).select(*COLUMNS)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay, and so do rows without an id.
    Rows that repeat an id stay or go together.  An empty benchmark drops nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return docs.join(contained_items(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each document, one row for each row; ids are null for a null text."""
    return encode_texts(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram jaccard join", keep_one_of_near_duplicates),
    ("benchmark decontamination", drop_benchmark_items),
    ("sentencepiece", encode),
]

#: SQL can't express the classifier or the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again; what a stage has read goes after it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch, before = Scratch(spark, "pipeline"), None
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
