import random

from pyspark.sql import functions as F

from stratum.llm.decontamination import contained_items, document_sketches, item_shingles, sketches
from stratum.llm.wordgrams import words as word_array

from .common import documents, edge_cases, prose, shingles, words


def brute(docs, items):
    texts: dict = {}
    for i, t in items:
        if i is not None:
            texts.setdefault(i, []).append(t)
    out = []
    by_doc: dict = {}
    for d, t in docs:
        if d is not None:
            by_doc.setdefault(d, []).append(t)
    for i, parts in texts.items():
        wanted = set().union(*(shingles(t) for t in parts))
        for d, own in by_doc.items():
            have = set()
            for t in own:
                w = words(t)
                for k in {len(s) for s in wanted}:
                    have |= {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
            common = len(wanted & have)
            if wanted and 100 * common >= 75 * len(wanted):
                out.append((d, i, len(wanted), common))
    return sorted(out)


def got(spark, docs, items):
    table = spark.createDataFrame([(i, t, None, None, None) for i, t in items], "item_id long, text string, n string, k string, h string")
    return sorted((r.doc_id, r.item_id, r.n_shingles, r.n_common) for r in contained_items(documents(spark, docs), table).collect())


def test_matches_brute_force(spark):
    rng = random.Random(1)
    items = [(i, prose(rng, rng.randrange(1, 40), 2000)) for i in range(25)] + [(100, None), (101, ""), (None, "a b c d e f"), (102, "the same"), (103, "The  SAME"), (104, "one two three four five six seven"), (104, "other words that repeat an id")]
    docs = edge_cases()
    for d in range(200, 260):
        text = prose(rng, rng.randrange(10, 300), 2000).split()
        w = words(rng.choice(items)[1])
        for _ in range(rng.randrange(3)):
            if w:
                w[rng.randrange(len(w))] = "changed"
        at = rng.randrange(len(text))
        docs.append((d, " ".join(text[:at] + w + text[at:]).upper()))
    found = got(spark, docs, items)
    assert found == brute(docs, items) and len(found) > 20


def test_containment_of_exactly_three_quarters(spark):
    items = [(1, "a b c d e f g h")]  # 4 shingles
    docs = [(1, "a b c d e f g x"), (2, "a b c d e f x h")]
    assert got(spark, docs, items) == [(1, 1, 4, 3)]


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a b")]) == [] and got(spark, [(1, "a b")], []) == [] and got(spark, [], []) == []


def test_sketches_are_partitioned_by_size(spark):
    rng = random.Random(3)
    items = spark.createDataFrame([(i, prose(rng, n, 10**6)) for i, n in enumerate([5, 6, 12, 20, 36, 68, 100, 200])], "item_id long, text string")
    rows = sketches(item_shingles(items)).collect()
    sizes = {i: n - 4 for i, n in enumerate([5, 6, 12, 20, 36, 68, 100, 200])}
    for i, n in sizes.items():
        own = [r for r in rows if r.item_id == i]
        assert len(own) == n + 1 - -(-3 * n // 4) and {r.part for r in own} == {n.bit_length() - 1} and {r.needed for r in own} == {-(-3 * n // 4)}
    parts = sorted({r.part for r in rows})
    table = [max((r for r in rows if r.part == p), key=lambda r: r.h).asDict() for p in parts]
    from pyspark.sql import Row

    bounds = [Row(part=t["part"], threshold=t["h"], needed=min(r.needed for r in rows if r.part == t["part"])) for t in table]
    tokens = documents(spark, [(1, prose(rng, 60, 10**6)), (2, prose(rng, 3000, 10**6))]).select("doc_id", word_array(F.col("text")).alias("words"))
    found = document_sketches(tokens, 5, bounds).collect()
    assert {r.part for r in found if r.doc_id == 1} <= {p.part for p in bounds if p.needed <= 56}  # too short for the others
    of_large = [r for r in found if r.doc_id == 2 and r.part == 7]
    assert 0.1 * 2996 < len(of_large) < 0.5 * 2996  # a quarter of the hash values, about
    assert all(r.h <= next(p.threshold for p in bounds if p.part == r.part) for r in found)
