import random
import re
from collections import Counter

import numpy as np
import pytest

from stratum.llm import collocations as C
from stratum.llm.collocations import mine_phrases

from .common import CLASHES, LOWER


def plain(rows, least, top):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    candidates = {g: a for g, a in counts.items() if len(g[1]) > 1 and a >= least}
    dropped = set()
    for (lang, w), f in candidates.items():
        dropped |= {(lang, w[i : i + k]) for k in range(2, len(w)) for i in range(len(w) - k + 1) if 100 * f >= 80 * counts[lang, w[i : i + k]]}
    found = {}
    for (lang, w), a in candidates.items():
        if (lang, w) not in dropped:
            cuts = [(2_000_000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, i, p.decode(), -a, left, right, totals[lang], -s) for lang, x in found.items() for i, (s, a, p, left, right) in enumerate(sorted(x)[:top], 1)}


def frame(spark, rows):
    schema = "text string, lang string, doc_id long, source string" + "".join(f", {c} string" for c in CLASHES)
    return spark.createDataFrame([(*r, None, None, *(None,) * len(CLASHES)) for r in rows], schema).repartition(3)


def compare(spark, rows, least, top=2000):
    got = [tuple(r) for r in mine_phrases(frame(spark, rows), least, top).top.collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, least, top)
    return got


def corpus(seed, n, vocabulary=30):
    rng = random.Random(seed)
    words = [*(f"w{i}" for i in range(vocabulary)), "Über", "ÜBER", "漢字", "A.B", "c-d", "x\x00y", "\U0001f600", "é\x1f"]
    phrases = ["new york city hall", "new york", "once upon a time", "a a a a a", "in order to"]
    return [
        (" ".join(rng.choice(phrases) if rng.random() < 0.2 else words[min(int(rng.expovariate(0.15)), len(words) - 1)] + rng.choice(["", "", "", ",", ".", "\n", "\t", "!?"]) for _ in range(rng.randrange(0, 60))), rng.choice(["en", "de", "", None, "und"]))
        for _ in range(n)
    ]


def test_phrases_match_brute_force(spark):
    rows = corpus(1, 200) + [(None, "en"), ("", "de"), (" \t. ,", "en"), ("rare words only here", "zz"), ("hot pair " * 20_000, "en"), ("same text again and again", "en")] + [("same text again and again", "en")] * 12
    got = compare(spark, rows, 10)
    assert any(r[2] == "new york" or "new york city hall" in r[2] for r in got) and any(len(r[2].split()) == 4 for r in got)


@pytest.mark.parametrize("top", [1, 7, 40])
def test_ties_are_settled_by_the_phrase(spark, top):
    rows = [(f"{a} {b}. {b} {a}", "en") for a, b in (("x", "y"), ("é", "z"), ("p", "q")) for _ in range(4)]
    got = compare(spark, rows, 3, top)
    assert len(got) == min(top, 6)


def test_empty_and_seldom(spark):
    assert mine_phrases(frame(spark, [])).top.isEmpty()
    assert mine_phrases(frame(spark, [("only once here", "en"), (None, None)])).top.isEmpty()


def test_runs_that_span_batches_are_added_up(spark):
    rows = corpus(2, 150, vocabulary=8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        compare(spark, rows, 5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_many_words_in_a_block_take_the_general_path():
    rng = np.random.default_rng(1)
    numbers = np.where(rng.random(4000) < 0.1, 0, rng.integers(1, 70_002, 4000)).astype("<u4")
    numbers = np.concatenate((numbers, numbers[:1500]))
    at = np.arange(70_000)  # words 1 ... 70,000; the last one has no id
    ids = rng.permutation(70_000) + 1
    keys, counts = C._block_keys(numbers, at, ids)
    want, g = Counter(), [0 if n == 0 or n > 70_000 else int(ids[n - 1]) for n in numbers.tolist()] + [0] * 3
    for i in range(len(numbers)):
        w = g[i : i + 4]
        w = w[: w.index(0)] if 0 in w else w
        if len(w) > 1:
            want[tuple(w + [0] * (4 - len(w)))] += 1
    assert dict(zip(map(tuple, keys.tolist()), counts.tolist(), strict=True)) == want
    assert keys.tolist() == sorted(keys.tolist())
    small = C._block_keys(np.array([1, 2, 0, 3, 1, 2], dtype="<u4"), np.array([0, 1, 2]), np.array([900_000, 5, 70]))
    assert small[0].tolist() == [[70, 900_000, 5, 0], [900_000, 5, 0, 0]] and small[1].tolist() == [1, 2]


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    words = spark.createDataFrame([("en", "a", 1, 9_000_000_000_000), ("en", "b", 2, 8_000_000_000_001)], "lang string, word string, id long, f long")
    grams = spark.createDataFrame([(bytes([0, 0, 0, 1, 0, 0, 0, 2]) + bytes(8), 7_000_000_000_000)], "key binary, f long")
    r = C._scored(grams, words).select("size", "lang", "a", "l", "r", "score").first()
    assert tuple(r) == (2, "en", 7_000_000_000_000, 9_000_000_000_000, 8_000_000_000_001, 2_000_000 * 7_000_000_000_000 // 17_000_000_000_001)
    assert grams.select(F.hex(C._id_key(F.lit(258)))).first()[0] == "00000102" + "0" * 24
