import random

import numpy as np
import pytest

from stratum.llm import jaccard_join
from stratum.llm.jaccard_join import near_duplicate_components

from .common import documents, edge_cases, prose, shingles


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and both and 100 * both >= 75 * either:
                root[find(i)] = find(j)
    smallest: dict = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[find(i)] = min(doc, smallest.get(find(i), doc))
    return sorted(((doc, len(sets[i]), None if doc is None else smallest[find(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        at = rng.randrange(len(w))
        w[at : at + rng.choice([0, 1, 1])] = [f"e{rng.randrange(10**6)}"]
    return " ".join(w)


def corpus(rng, groups, size):
    rows, doc = [], 1000
    for _ in range(groups):
        text = prose(rng, rng.randrange(5, 150), 300)
        for _ in range(rng.randrange(1, size)):
            text = edited(rng, text, rng.randrange(4))  # chains: ends may be far apart
            rows.append((doc, text))
            doc += rng.randrange(1, 3)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed):
    rows = corpus(random.Random(seed), 40, 8) + edge_cases()
    assert got(near_duplicate_components(documents(spark, rows))) == brute(rows)


def test_a_large_group_around_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 2000)
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", 30)
    monkeypatch.setattr(jaccard_join, "MEMBERS_PER_TASK", 7)
    rng = random.Random(7)
    text = prose(rng, 100, 10_000)
    rows = [(i, edited(rng, text, rng.randrange(2, 6))) for i in range(160)] + [(1000 + i, text) for i in range(30)]
    assert got(near_duplicate_components(documents(spark, rows))) == brute(rows)


def test_members_out_of_reach_leave_their_list():
    rng = random.Random(3)
    members = sorted((rng.randrange(40), rng.randrange(4, 60), rng.randrange(16)) for _ in range(400))
    key, n = np.array([m[0] for m in members]), np.array([m[1] for m in members])
    position = np.array([m[2] % max(1, jaccard_join.prefix_length(m[1])) for m in members])
    reach = jaccard_join.reach(n, position)
    want = [any(key[i] == key[j] and i != j and n[j] <= reach[i] and n[i] <= reach[j] for j in range(len(n))) for i in range(len(n))]
    assert jaccard_join.within_reach(key, n, reach).tolist() == want and 0 < sum(want) < len(want)


def test_reach_is_the_bound_of_the_overlap():
    for n in range(1, 60):
        for at in range(jaccard_join.prefix_length(n)):
            for m in range(1, 90):
                assert (175 * min(n - at, m) >= 75 * (n + m)) == (m <= jaccard_join.reach(n, at) and 100 * m >= 75 * n)


def test_derived_answers_join_what_the_pairs_join():
    rng = random.Random(4)
    for _ in range(60):
        base = rng.sample(range(1000), 60)
        sets = {i: np.unique(np.array(rng.sample(base, rng.randrange(40, 60)) + rng.sample(range(1000, 2000), rng.randrange(8)), dtype=np.uint64)) for i in range(14)}
        pairs = [(i, j) for i in range(14) for j in range(i + 1, 14) if rng.random() < 0.6]
        links = jaccard_join.links_among(pairs, sets)
        assert set(links) <= set(pairs) and all(jaccard_join.similar(sets[a], sets[b]) for a, b in links)

        def groups(edges):
            root = list(range(14))
            for _ in range(14):
                for a, b in edges:
                    root[a] = root[b] = min(root[a], root[b])
            return root

        assert groups(links) == groups([(a, b) for a, b in pairs if jaccard_join.similar(sets[a], sets[b])])


def test_candidates_are_all_pairs_that_pass_both_filters():
    import pyarrow as pa

    rng = random.Random(6)
    found = 0
    for n in (2, 3, 3, 3, 3, 3, 40):  # by pairs, and by shingles
        prefixes = [[np.uint32(x) for x in rng.sample(range(60 if n == 40 else 20), rng.randrange(3, 15))] for _ in range(2 * n)]
        prefixes[0][2] = prefixes[0][0]  # a twin
        sizes = [rng.randrange(4 * len(p) - 4, 4 * len(p)) for p in prefixes]
        kind = pa.struct([("fp", pa.int64()), ("n", pa.int64()), ("label", pa.int64()), ("prefix", pa.binary())])
        rows = [{"fp": i, "n": sizes[i], "label": i // 2, "prefix": np.array(p, dtype=np.uint32).tobytes()} for i, p in enumerate(prefixes)]
        one, two = (jaccard_join.Block.of(k, pa.array(rows[k * n : (k + 1) * n], kind)) for k in (0, 1))
        want = []
        for i in range(n):
            for j in range(n, 2 * n):
                common = set(prefixes[i]) & set(prefixes[j])
                if not common or i // 2 == j // 2 or 100 * min(sizes[i], sizes[j]) < 75 * max(sizes[i], sizes[j]):
                    continue
                needed = -(-75 * (sizes[i] + sizes[j]) // 175) - -(-75 * max(sizes[i], sizes[j]) // 100) + 1
                at, to = (min(p.index(x) for x in common) for p in (prefixes[i], prefixes[j]))
                if len(common) >= max(needed, 1) and sizes[j] <= jaccard_join.reach(sizes[i], at) and sizes[i] <= jaccard_join.reach(sizes[j], to):
                    want.append((i, j))
        got = list(zip(*(x.tolist() for x in one.candidates(two)), strict=True))
        assert got == want
        found += len(want)
    assert found > 10


def test_hot_lists_are_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT_POSTINGS", 5)
    rows = corpus(random.Random(5), 15, 12)
    assert got(near_duplicate_components(documents(spark, rows))) == brute(rows)


def test_texts_that_share_an_id(spark):
    a, b, c = (prose(random.Random(i), 40, 10_000) for i in (1, 2, 3))
    rows = [(5, a), (5, b), (3, a + " tail"), (9, b + " tail"), (7, c), (7, c)]
    out = sorted((r.doc_id, r.component_id) for r in near_duplicate_components(documents(spark, rows)).collect())
    assert out == [(3, 3), (5, 3), (5, 5), (7, 7), (7, 7), (9, 5)]


def test_the_threshold_itself(spark):
    # 7 words have 3 shingles, 8 have 4: 3 of 4 is 0.75.
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "p q r s t u"), (4, "p q r s t u v")]
    assert got(near_duplicate_components(documents(spark, rows))) == brute(rows)


def test_nothing(spark):
    assert got(near_duplicate_components(documents(spark, []))) == []
    assert got(near_duplicate_components(documents(spark, [(1, None), (None, None)]))) == [(1, 0, 1), (None, 0, None)]
