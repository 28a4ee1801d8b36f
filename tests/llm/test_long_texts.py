"""One text that is larger than a block and than an Arrow batch, through every operator that reads texts."""

import random

import pytest
from pyspark.sql import functions as F

from stratum.llm.decontamination import contained_items
from stratum.llm.jaccard_join import near_duplicate_components
from stratum.llm.license_scan import scan_licenses
from stratum.llm.line_dedup import dedup_lines
from stratum.llm.lm_scoring import score_texts
from stratum.llm.pieces import decode_tokens, encode_texts
from stratum.llm.pii import pseudonymize
from stratum.llm.quality_classifier import classify
from stratum.llm.support import BATCH_BYTES
from stratum.llm.textarrays import BLOCK_BYTES

from .common import documents, prose

ITEM = "an item of the benchmark that stands at the very end of it"
TAIL = f"a line of two\nand its neighbour\nmit license call +1 (743) 555-3824 {ITEM}"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    long = "\n".join(prose(rng, 10, 50_000) for _ in range(110_000))
    assert len(long) > max(BLOCK_BYTES, BATCH_BYTES)
    return [(1, "short"), (2, f"{long}\n{TAIL}"), (3, f"{long}\n{TAIL} more"), (4, ""), (5, None), (6, "a line of two\nand its neighbour\nx")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return documents(spark, rows)


def test_scores_and_pieces(docs, rows):
    n_words = {i: len((t or "").split()) for i, t in rows}
    assert {r.doc_id: r.n_tokens for r in score_texts(docs, F.lit(True)).collect()} == {i: n + 1 for i, n in n_words.items()}
    pytest.importorskip("public_tokenizers")
    back = decode_tokens(encode_texts(docs)).select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("digest"), "n_tokens").collect()
    import hashlib

    assert {r.doc_id: r.digest for r in back} == {i: t if t is None else hashlib.md5(t.encode()).hexdigest() for i, t in rows}


def test_near_duplicates_and_lines(docs, rows):
    assert {r.doc_id: r.component_id for r in near_duplicate_components(docs).collect()} == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5, 6: 6}
    out = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert out[2].n_removed_lines == 0 and out[3].text == rows[2][1].split("\n")[-1] and out[6].text == "x"


def test_searches_at_the_end_of_the_text(spark, docs, rows):
    items = spark.createDataFrame([(9, ITEM)], "item_id long, text string")
    assert sorted(r.doc_id for r in contained_items(docs, items).collect()) == [2, 3]
    found = {r.doc_id: [s.label for s in r.phrase_starts] for r in scan_licenses(docs).collect()}
    assert found == {1: [], 2: ["mit"], 3: ["mit"], 4: [], 5: [], 6: []}
    out = {r.doc_id: r for r in pseudonymize(docs, b"key").collect()}
    assert [s.kind for s in out[2].spans] == ["phone"] and len(out[2].text) == len(rows[1][1]) and out[2].text != rows[1][1]


def test_quality(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert classify(docs, labels, F.lit(True)).where("score IS NOT NULL").count() == 6


def test_phrases_and_terms_of_a_text_larger_than_a_batch(spark):
    from stratum.llm.queries import divergence_rows
    from stratum.llm.source_divergence import audit_sources

    from . import test_collocations as phrases
    from . import test_source_divergence as terms

    rng = random.Random(12)
    long = " ".join(rng.choice(("alpha beta", "gamma", "delta epsilon,", "zeta.", "eta theta iota")) for _ in range(700_000))
    assert len(long) > 6 << 20
    rows = [(long, "en"), ("alpha beta gamma", "en"), (long[:2000], "de")]
    phrases.compare(spark, rows, 10)
    sourced = [(t, lang, s) for (t, lang), s in zip(rows, "aba", strict=True)]
    got = {tuple(r) for r in divergence_rows(audit_sources(terms.frame(spark, sourced), 1, 50)).collect()}
    assert got == terms.plain(sourced, 1, 50)
