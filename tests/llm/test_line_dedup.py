import random

import numpy as np
import pyarrow as pa

from stratum.llm.line_dedup import Lines, dedup_lines
from stratum.llm.textarrays import text_blocks

from .common import documents, edge_cases, prose


def brute(rows):
    def lines(text):
        ls = text.split("\n")
        tail = ls[-1] == "" and len(ls) > 1
        return (ls[:-1] if tail else ls), tail

    def chunks(ls):
        for i in range(1, len(ls)):
            yield i - 1, (ls[i - 1], ls[i])

    first: dict = {}
    for d, t in rows:
        if d is not None and t:
            for i, c in chunks(lines(t)[0]):
                first[c] = min(first.get(c, (d, i)), (d, i))
    out = []
    for d, t in rows:
        if d is None or not t:
            out.append((d, t))
            continue
        ls, tail = lines(t)
        gone = {j for i, c in chunks(ls) if first[c] != (d, i) for j in range(i, i + len(c))}
        kept = [x for i, x in enumerate(ls) if i not in gone]
        out.append((d, "\n".join(kept) + ("\n" if tail and kept else "")))
    return sorted(out, key=str)


def got(spark, rows):
    return sorted(((r.doc_id, r.text) for r in dedup_lines(documents(spark, rows)).collect()), key=str)


def test_matches_brute_force(spark):
    rng = random.Random(1)
    pool = [prose(rng, rng.randrange(1, 12), 50) for _ in range(60)] + ["", " ", prose(rng, 70)]
    passages = [[rng.choice(pool) for _ in range(rng.randrange(2, 6))] for _ in range(6)]
    rows = edge_cases()
    for d in range(100, 160):
        ls = [rng.choice(pool) if rng.random() < 0.3 else prose(rng, 8, 5000) for _ in range(rng.randrange(1, 15))]
        at = rng.randrange(len(ls))
        ls[at:at] = rng.choice(passages) * rng.randrange(3)
        rows.append((d, "\n".join(ls) + "\n" * rng.randrange(2)))
    assert got(spark, rows) == brute(rows)


def test_passages_go_but_for_the_first_place(spark):
    passage = "one line of it\nand another line"
    rows = [(2, f"x\n{passage}\ny"), (1, f"a\nb\n{passage}"), (3, passage), (4, "one line of it\nalone"), (5, f"{passage}\nq\n{passage}")]
    assert got(spark, rows) == [(1, f"a\nb\n{passage}"), (2, "x\ny"), (3, ""), (4, "one line of it\nalone"), (5, "q")]


def boundaries(text):
    (_, _, data, offsets), = text_blocks(pa.array([text]))
    before, after = Lines(data, offsets).chosen()
    return before | after


def test_boundaries_are_a_choice_that_insertions_do_not_shift():
    rng = random.Random(2)
    lines = [prose(rng, 6, 5000) for _ in range(3000)]
    chosen = boundaries("\n".join(lines))
    assert 0.6 < chosen.mean() < 0.72  # two in three
    inserted = boundaries("\n".join(lines[:1000] + ["an inserted line", "and one more"] + lines[1000:]))
    assert np.array_equal(inserted[:999], chosen[:999]) and np.array_equal(inserted[1003:], chosen[1001:])


def test_recall_by_length_of_passage_is_whole(spark):
    rng = random.Random(3)
    rows, expected = [], {}
    for n in range(2, 9):
        for repeat in range(20):
            passage = [prose(rng, 5, 10**6) for _ in range(n)]
            for copy in range(2):
                own = [prose(rng, 5, 10**6) for _ in range(4)]
                doc = 1000 * n + 10 * repeat + copy
                rows.append((doc, "\n".join(own[:2] + passage + own[2:])))
                expected[doc] = n if copy else 0
    out = {r.doc_id: r.n_removed_lines for r in dedup_lines(documents(spark, rows)).collect()}
    assert out == expected


def test_counts_are_told_and_lines_that_are_repeated_alone_stay(spark):
    line = prose(random.Random(1), 80)
    rows = [(1, f"a\n{line}\nb"), (2, f"{line}\nb\nc"), (3, f"{line}\nd")]
    out = {r.doc_id: r for r in dedup_lines(documents(spark, rows), carry=("lang", "n_chars", "doubtful", "label")).collect()}
    assert out[2].text == "c" and (out[2].n_lines, out[2].n_removed_lines, out[2].n_removed_chunks) == (3, 2, 1)
    assert out[1].n_removed_lines == 0 and out[1].n_chars == len(f"a\n{line}\nb")
    assert out[3].text == f"{line}\nd"


def test_rows_of_one_id_with_different_texts(spark):
    rows = [(1, "p\nq\nr"), (1, "x\ny\nz"), (2, "x\ny"), (3, "p\nq")]
    assert got(spark, rows) == [(1, "p\nq\nr"), (1, "x\ny\nz"), (2, ""), (3, "")]


def test_rows_that_repeat_an_id_keep_the_first_place(spark):
    text = "same line\nnext line"
    assert got(spark, [(1, text), (1, text), (2, text)]) == [(1, text), (1, text), (2, "")]


def test_nothing(spark):
    assert got(spark, []) == []
