import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline

from .common import documents, edge_cases, prose, shingles
from .test_decontamination import brute as contained
from .test_jaccard_join import brute as components
from .test_line_dedup import brute as deduped

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_on_their_own_input(spark, tmp_path):
    """Each stage against its brute-force version, on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns = list(corpus_pipeline.COLUMNS)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = pairs(docs)
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if name == "quality classifier":
            kept = {i for i, _ in pairs(docs)}
            held = [(i in kept, labels[i] == 1) for i, _ in before if i in labels]
            assert sum(a == b for a, b in held) / len(held) > 0.9
            assert pairs(docs) == [p for p in before if p[0] in kept]
        elif name == "line dedup":
            assert pairs(docs) == [p for p in deduped(before) if p[1] != "" or (p[0], "") in before]
        elif name == "n-gram jaccard join":
            first = {d for d, _, c in components(before) if d == c}
            assert pairs(docs) == [p for p in before if p[0] in first]
        elif name == "benchmark decontamination":
            bad = {d for d, *_ in contained(before, benchmark)}
            assert bad and pairs(docs) == [p for p in before if p[0] not in bad]
        else:
            assert {r.doc_id for r in docs.collect()} == {i for i, _ in before}
            columns = ["doc_id", "n_tokens", "ids"]
        assert docs.columns == columns


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids"] and 0 < out.count() <= 200


@pytest.mark.parametrize("rows", [[], edge_cases()])
def test_stages_pass_edge_cases(spark, tmp_path, rows):
    """Each stage on the edge cases themselves: columns, and which rows stay."""
    docs = documents(spark, rows)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{number}")
        out = spark.read.parquet(f"{tmp_path}/{number}")
        if name == "sentencepiece":
            assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() == len(rows)
            assert sorted(str(r.doc_id) for r in out.collect() if r.ids is None) == sorted(str(i) for i, t in rows if t is None)
            continue
        assert out.columns == list(corpus_pipeline.COLUMNS)
        if name == "quality classifier":
            assert set(pairs(out)) <= set(rows)
        elif name == "n-gram jaccard join":  # 5 is a copy of 4, 6 stands twice
            assert pairs(out) == sorted({r for r in rows if r[0] != 5}, key=str)
        else:
            assert pairs(out) == sorted(rows, key=str)


def test_one_row_of_copies_and_repeated_ids_stays(spark):
    text, other = "one two three four five six seven", "a text of its own that is kept in any case"
    rows = [(3, text), (3, text), (4, text), (5, text), (5, other), (None, text), (None, text)]
    assert pairs(corpus_pipeline.keep_one_of_near_duplicates(spark, documents(spark, rows), SF)) == sorted([(3, text), (5, text), (5, other), (None, text), (None, text)], key=str)


def test_n_chars_follows_the_text(spark):
    rng = random.Random(1)
    passage = f"{prose(rng, 40)}\n{prose(rng, 20)}"
    rows = [(1, f"a\n{passage}"), (2, f"{passage}\nb")]
    out = {r.doc_id: r for r in corpus_pipeline.drop_repeated_lines(spark, documents(spark, rows), SF).collect()}
    assert (out[2].text, out[2].n_chars) == ("b", 1) and out[1].n_chars == len(rows[0][1])


@pytest.mark.parametrize("name", ["op1_sharding", "op4_jaccard_join", "op6_topk", "op7_decontamination", "op8_licenses", "op10_line_dedup"])
def test_queries_match_their_oracles(spark, name):
    import duckdb

    oracle = entry.oracle_sql().get(name)
    if oracle is None:
        pytest.skip("no oracle")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    df = entry.queries()[name](spark, SF)
    want = con.execute(oracle)
    names = [c[0] for c in want.description]
    plain = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    got = sorted(map(plain, df.select(*names).collect()), key=str)
    assert got == sorted(map(plain, want.fetchall()), key=str)


def test_all_are_registered_with_their_columns(spark):
    have = {int(n[2:].split("_")[0]): n for n in entry.queries() if n.startswith("op")}
    assert sorted(have) == list(range(1, 14)) and "pipeline" in entry.queries()
    wanted = {
        2: [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double")],
        4: [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")],
        5: [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
        3: [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids", "array<int>"), ("decoded_md5", "string")],
        9: [("doc_id", "bigint"), ("n_found", "bigint"), ("kinds", "string"), ("text", "string")],
        6: [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")],
        8: [("doc_id", "bigint"), ("n_words", "bigint"), ("n_base", "bigint"), ("first_word", "bigint"), ("last_word", "bigint"), ("base_labels", "string"), ("labels", "string"), ("score", "double")],
        11: [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")],
        12: [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")],
        13: [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *((c, "bigint") for c in ("a", "l", "r", "n", "score"))],
    }
    for n, columns in wanted.items():
        assert entry.queries()[have[n]](spark, SF).dtypes[: len(columns)] == columns


def test_shingles_helper():
    assert shingles("A b") == {("a", "b")} and F is not None
