import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import lm_scoring as lm

from .common import documents, edge_cases, prose, words


def base_scores(rows, learn):
    counts = Counter()
    for i, t in rows:
        if i is not None and learn(i):
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*words(t), None]
        out.append((i, len(tokens), sum(counts[w] > 0 for w in tokens), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens), 6)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


def test_base_is_exact_and_edge_cases_pass(spark):
    rng = random.Random(2)
    data = edge_cases() + [(100 + i, prose(rng, rng.randrange(80))) for i in range(60)]
    df = lm.score_texts(documents(spark, data), F.col("doc_id") % 3 != 1)
    assert got(df) == base_scores(data, lambda i: i % 3 != 1)


def test_many_segments_give_the_same_scores(spark, monkeypatch):
    rng = random.Random(3)
    docs = documents(spark, [(i, prose(rng, 200, 60)) for i in range(40)])
    whole = {r.doc_id: r.score for r in lm.score_texts(docs, F.col("doc_id") % 5 != 1).collect()}
    monkeypatch.setattr(lm, "MAX_BROADCAST", 300)
    monkeypatch.setattr(lm, "ENTRIES_PER_BUCKET", 100)
    passes, probed, real = [], [], lm.Filter.segments

    def segments(self):
        for segment in real(self):
            passes.append(segment)
            yield segment

    def keep(self, df, name, by=None, real=lm.Scratch.keep):
        kept = real(self, df, name, by)
        if name == "asked":
            probed.extend(r.segment for r in kept.select("block", "segment").collect())
        return kept

    monkeypatch.setattr(lm.Filter, "segments", segments)
    monkeypatch.setattr(lm.Scratch, "keep", keep)
    parts = {r.doc_id: r.score for r in lm.score_texts(docs, F.col("doc_id") % 5 != 1).collect()}
    assert len(passes) >= 20 and all(len(s.bits) <= 300 or len(s.sizes) == 1 for s in passes)
    assert set(probed) <= set(range(len(passes))) and len(probed) <= 3 * len(passes)  # a slice for each block and segment
    # Other buckets have other false positives, so scores are close, not equal.
    assert all(abs(whole[i] - parts[i]) < 0.02 * 201 for i in whole)


def exact_scores(rows, learn, rates):
    """The model with exact counts in place of the filter, and the room of its rates."""
    ones, pairs, texts = Counter(), Counter(), 0
    for i, t in rows:
        if learn(i):
            tokens = [*words(t), None]
            ones.update(tokens)
            pairs.update(zip(["<", *tokens[:-1]], tokens, strict=True))
            texts += 1
    n, v, low = sum(ones.values()), len(ones), lm.thresholds()
    for i, t in rows:
        tokens = [*words(t), None]
        logs = [0.0] * len(lm.WEIGHTS)
        for h, w in zip(["<", *tokens[:-1]], tokens, strict=True):
            p, c = (ones[w] + 0.5) / (n + 0.5 * (v + 1)), texts if h == "<" else ones[h]
            joint = max((x for x in low if x <= pairs[h, w]), default=0)
            strangers = rates[0] * v
            room = (c + strangers + 4 * math.sqrt(strangers)) / (1 - rates[1])
            for k, weight in enumerate(lm.WEIGHTS):
                u = weight * c / room if c else 0
                logs[k] += math.log10(u * joint / room + (1 - u) * p if c else p)
        best = max(logs)
        yield i, len(tokens), best + math.log10(sum(10 ** (x - best) for x in logs) / len(logs))


def test_scores_are_those_of_exact_counts_but_for_false_positives(spark, monkeypatch):
    rates, real = [], lm.Filter.__init__

    def made(self, parts, buckets):
        real(self, parts, buckets)
        rates.append(self.rates)

    monkeypatch.setattr(lm.Filter, "__init__", made)
    rng = random.Random(6)
    data = [(i, prose(rng, rng.randrange(150), 80)) for i in range(80)] + [(200, None), (201, "never seen words")]
    got = {r.doc_id: r.score for r in lm.score_texts(documents(spark, data), F.col("doc_id") % 5 != 1).collect()}
    exact = list(exact_scores(data, lambda i: i % 5 != 1, rates[0]))
    assert all(got[i] >= score - 1e-6 for i, _, score in exact)
    assert sum(got[i] - score for i, _, score in exact) < 0.01 * sum(n for _, n, _ in exact)
    assert sum(got[i] - score < 1e-6 for i, _, score in exact) > len(exact) / 4


def built(hashes: np.ndarray, counts: np.ndarray, buckets: int = 4) -> tuple[lm.Segment, np.ndarray, tuple[float, float]]:
    """A filter of these bigrams in memory: (segment, set bits, rates)."""
    import pyarrow as pa

    sizes, bits, share = [], [], []
    of = lm.bucket_of(hashes, buckets)
    for b in range(buckets):
        own, n, entries = hashes[of == b], counts[of == b], []
        while (n > 0).any():
            entries.append(own[n > 0] | np.minimum(n[n > 0], 255).astype(np.uint64))
            n = n - 255
        table = pa.table({"bucket": pa.array([b], pa.int32()), "entries": pa.array([np.concatenate(entries).view(np.int64).tolist()])})
        part = lm._build(table)
        sizes.append(part.column("size")[0].as_py())
        share.append(part.column("n_set")[0].as_py() / sizes[-1])
        raw = np.frombuffer(part.column("bits")[0].as_py(), dtype=np.uint8)
        bits.append(raw)
    share = np.array(share)
    return lm.Segment(np.array(sizes), np.concatenate(bits)), share, (float((share**lm.FIRST_PROBES).mean()), float((share**lm.PROBES).mean()))


def test_probabilities_through_the_filter_add_up_to_one_at_most():
    """The sum over a vocabulary of 100,000, false positives included, for histories of all frequencies."""
    rng = np.random.default_rng(7)
    v, buckets = 100_000, 4
    words = lm.mix(np.arange(1, v + 1, dtype=np.uint64))
    # Histories 0 ... 299 have counts 1, 10 and 1,000 (100 of each); others make up the rest of the corpus.
    counts_of = np.repeat([1, 10, 1000], 100)
    left = np.concatenate((np.repeat(np.arange(300), counts_of), rng.integers(300, v, 400_000)))
    right = np.minimum((rng.random(len(left)) ** 3 * v).astype(np.int64), v - 1)
    pairs, counts = np.unique(left * v + right, return_counts=True)
    hashes = lm.bigram_hashes(words[pairs // v], words[pairs % v])
    segment, share, rates = built(hashes, counts, buckets)
    assert 0.3 < share.mean() < 0.5 and rates[0] < 0.001
    c_word = np.maximum(np.bincount(right, minlength=v), 1).astype(float)
    word = (c_word + 0.5) / (c_word.sum() + 0.5 * (v + 1))
    totals = {weight: [] for weight in lm.WEIGHTS}
    for h, c in enumerate(counts_of):
        asked = lm.bigram_hashes(np.full(v, words[h]), words)
        levels = segment.levels(lm.bucket_of(asked, buckets), lm.filter_keys(asked))
        joint = np.minimum(lm.level_values()[levels], np.minimum(c_word, c))
        assert joint.sum() > c * 0.7
        for weight in lm.WEIGHTS:
            totals[weight].append(float((word * lm.conditional(weight, joint, np.full(v, float(c)), word, lm.room(np.full(v, float(c)), v, rates))).sum()))
    assert max(map(max, totals.values())) <= 1.01
    # Frequent histories keep most of their weight, so bigrams still tell.
    assert 1000 / lm.room(np.array([1000.0]), v, rates)[0] > 0.85


def test_held_out_texts_are_likelier_than_by_the_base(spark):
    rng = random.Random(9)
    follow = {w: [rng.randrange(300) for _ in range(4)] for w in range(300)}

    def chain():
        w, out = rng.randrange(300), []
        for _ in range(100):
            out.append(f"w{w}")
            w = rng.choice(follow[w])
        return " ".join(out)

    data = [(i, chain()) for i in range(100)]
    held_out = [r for r in lm.score_texts(documents(spark, data), F.col("doc_id") % 5 != 1).collect() if r.doc_id % 5 == 1]
    assert len(held_out) == 20 and all(r.score > r.base_score + 50 for r in held_out)


def test_the_model_knows_copies_and_is_never_far_below_the_base(spark):
    rng = random.Random(4)
    texts = [prose(rng, 120, 3000) for _ in range(60)]
    data = [(i, t) for i, t in enumerate(texts)] + [(1001, texts[0]), (1006, prose(rng, 120, 3000))]
    rows = {r.doc_id: r for r in lm.score_texts(documents(spark, data), F.col("doc_id") < 1000).collect()}
    assert rows[1001].score > rows[1001].base_score + 100
    assert all(r.score >= r.base_score - math.log10(len(lm.WEIGHTS)) - 1e-6 for r in rows.values())


def test_filter_gives_quantised_counts():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64) << np.uint64(8))
    counts = rng.integers(1, 200, len(hashes))
    import pyarrow as pa

    table = pa.table({"bucket": pa.array([0], pa.int32()), "entries": pa.array([(hashes | counts.astype(np.uint64)).view(np.int64).tolist()])})
    part = lm._build(table)
    segment = lm.Segment(np.array([part.column("size")[0].as_py()]), np.frombuffer(part.column("bits")[0].as_py(), dtype=np.uint8))
    levels_of = lambda x: segment.levels(np.zeros(len(x), dtype=np.int64), lm.filter_keys(x))
    levels = levels_of(hashes)
    want = np.searchsorted(lm.thresholds(), counts, side="right")
    assert (levels >= want).all() and (levels == want).mean() > 0.97  # a false positive raises a count by a level
    strangers = np.unique(rng.integers(0, 1 << 63, 20_000).astype(np.uint64) << np.uint64(8))
    assert (levels_of(np.setdiff1d(strangers, hashes)) > 0).mean() < 0.02
    values = lm.level_values()
    assert (values[want] <= counts).all() and values[1] == 1 and values[2] == 2


@pytest.mark.parametrize("data", [[], [(1, "a b")], [(None, None)]])
def test_little_or_nothing_to_learn_from(spark, data):
    df = lm.score_texts(documents(spark, data), F.lit(False))
    assert got(df) == base_scores(data, lambda i: False)
