import math
import random

import pytest
from pyspark.sql import functions as F

from stratum.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, shard string, v string"


def brute(rows, is_query, k):
    kept = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            kept[i] = [math.floor(64 * x) for x in v]
    out = []
    for q, a in kept.items():
        if is_query(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in kept.items() if i != q and len(b) == len(a))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, None, None, None, None) for i, v in rows], SCHEMA).repartition(3)


def got(spark, rows, k=5):
    return sorted(map(tuple, topk.top_k(table(spark, rows), F.col("vec_id") % 4 == 0, k).collect()))


def vectors(rng, n, dimension=6, centres=5):
    middle = [[rng.uniform(-1, 1) for _ in range(dimension)] for _ in range(centres)]
    # Multiples of 1/64, which floats hold exactly.
    return [(i, [round(64 * (c + rng.gauss(0, 0.1))) / 64 for c in rng.choice(middle)]) for i in range(n)]


@pytest.mark.parametrize("shard, leaf, block", [(16_384, 64, 128), (40, 4, 8)])
def test_matches_brute_force(spark, monkeypatch, shard, leaf, block):
    for name, value in (("SHARD_ROWS", shard), ("LEAF_ROWS", leaf), ("BLOCK_QUERIES", block), ("BLOCKS_PER_TASK", 2), ("NEAREST", 2), ("BOX_BYTES", 500)):
        monkeypatch.setattr(topk, name, value)
    rows = vectors(random.Random(1), 300)
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # a hot vector: ties by id
    assert got(spark, rows) == brute(rows, lambda i: i % 4 == 0, 5)


def test_edge_cases(spark):
    rows = [(0, [1.0, 0.5]), (4, [0.5, 1.0]), (4, [0.5, 1.0]), (5, None), (6, []), (8, [1.0, None]), (12, [1.0, float("nan")]), (16, [float("inf"), 1.0]), (None, [1.0, 1.0]), (20, [1.0, 2.0, 3.0]), (24, [-1.0, -1.0]), (28, [50_000.0, 3.0])]
    assert got(spark, rows) == brute(rows, lambda i: i % 4 == 0, 5)
    assert got(spark, []) == [] and got(spark, [(4, [1.0])]) == []


def test_large_components_are_exact(spark):
    rows = [(i, [float(2**22 + i), float(2**21 - i)]) for i in range(12)]
    assert got(spark, rows) == brute(rows, lambda i: i % 4 == 0, 5)


def test_far_shards_get_no_queries(spark, monkeypatch):
    """Two groups far apart in direction: no query of one is sent to a shard of the other."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    rng = random.Random(2)
    rows = [(i, [(1 if i % 2 else -1) * (3 + rng.random()), rng.random()]) for i in range(400)]
    sent, side = [], {i: v[0] > 0 for i, v in rows}

    def keep(self, df, name, by=None, real=topk.Scratch.keep):
        kept = real(self, df, name, by)
        if name == "shards":
            sent.extend(("shard", r.shard, r.ids) for r in kept.collect())
        if name == "asked":
            sent.extend(("asked", r.shard, r.ids) for r in kept.collect())
        return kept

    monkeypatch.setattr(topk.Scratch, "keep", keep)
    assert got(spark, rows) == brute(rows, lambda i: i % 4 == 0, 5)
    of_shard = {shard: {side[i] for i in ids} for kind, shard, ids in sent if kind == "shard"}
    asked = [(shard, i) for kind, shard, ids in sent if kind == "asked" for i in ids]
    assert len(of_shard) >= 10 and asked
    assert all(side[i] in of_shard[shard] for shard, i in asked)
    assert len(asked) < 100 * len(of_shard) / 2


def test_shards_of_long_vectors_are_sized_by_bytes_and_read_from_files(spark, monkeypatch):
    """1,536 components: shards of few rows; what is sent to them holds queries only."""
    monkeypatch.setattr(topk, "SHARD_BYTES", 8 * 1536 * 20)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 4)
    rng, shards, sent = random.Random(3), [], []
    rows = [(i, [rng.randrange(-64, 64) / 64 for _ in range(1536)]) for i in range(90)]

    def keep(self, df, name, by=None, real=topk.Scratch.keep):
        kept = real(self, df, name, by)
        if name == "shards":
            shards.extend(len(r.ids) for r in kept.collect())
        if name == "asked":
            sent.extend(i for r in kept.collect() for i in r.ids)
        return kept

    monkeypatch.setattr(topk.Scratch, "keep", keep)
    found = topk.top_k(table(spark, rows), F.col("vec_id") % 4 == 0, 5)
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 4 == 0, 5)
    assert sum(shards) == 90 and len(shards) >= 5 and max(shards) <= 40 and all(i % 4 == 0 for i in sent)
