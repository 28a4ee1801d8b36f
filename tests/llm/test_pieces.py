import os
import random

import numpy as np
import pytest

from stratum.llm import pieces
from stratum.llm.pieces import Automaton, Vocabulary, decode_tokens, encode_block, encode_texts
from stratum.llm.textarrays import text_blocks

from .common import documents, edge_cases

TOY = ["▁a", "▁ab", "b", "c", "bc", "abc", "▁", "▁▁", "ü", "cc", "▁abcc"]


def toy(more=()) -> Vocabulary:
    rng = random.Random(1)
    names = [*TOY, *more]
    return Vocabulary([p.encode() for p in names], np.arange(256, 256 + len(names), dtype=np.int32), np.array([rng.uniform(-9, -1) for _ in names]), np.arange(256, dtype=np.int32))


def best_score(v: Vocabulary, text: str) -> float:
    """Best path over the whole text by plain dynamic programming over all pieces."""
    mark = pieces.MARK
    literal = []
    raw = b""
    for c in " " + text:
        piece = mark if c == " " else c.encode()
        literal += [c == "▁"] * len(piece)
        raw += piece
    worst = float(v.scores.min()) - pieces.BYTE_PENALTY
    best = [0.0] + [-np.inf] * len(raw)
    for end in range(1, len(raw) + 1):
        best[end] = best[end - 1] + worst
        for p, s in zip(v.pieces, v.scores, strict=True):
            if raw[:end].endswith(p) and end >= len(p) and not any(literal[end - len(p) : end]):
                best[end] = max(best[end], best[end - len(p)] + s)
    return best[-1]


@pytest.mark.parametrize("more", [[], ["b▁c", "a▁"]])
def test_best_path_matches_dynamic_programming(more):
    import pyarrow as pa

    v = toy(more)
    assert Automaton(v).whole == bool(more)
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "b", "c", " ", "ü", "x", "▁", "\n"]) for _ in range(rng.randrange(1, 25))) for _ in range(300)] + ["", " ", "   a"]
    automaton = Automaton(v)
    score_of = dict(zip(v.ids.tolist(), v.scores.tolist(), strict=True))
    worst = float(v.scores.min()) - pieces.BYTE_PENALTY
    for first, end, data, offsets in text_blocks(pa.array(texts)):
        tokens, bounds = encode_block(automaton, data, offsets)
        for i in range(first, end):
            own = tokens[bounds[i - first] : bounds[i - first + 1]].tolist()
            # Bytes of a space are written as the mark, which no path covers by bytes: they count as pieces.
            got = sum(score_of.get(t, worst) for t in own)
            want = best_score(v, texts[i]) if texts[i] else 0.0
            assert got == pytest.approx(want), texts[i]


def model() -> str | None:
    try:
        return pieces.public_model()
    except ImportError:
        return None


needs_model = pytest.mark.skipif(not model() or not os.path.exists(model()), reason="no model")


@needs_model
def test_ids_of_the_real_model_are_a_best_path():
    import pyarrow as pa

    v = Vocabulary.load(model())
    score, longest = dict(zip(v.pieces, v.scores.tolist(), strict=True)), max(map(len, v.pieces))
    by_id = dict(zip(v.ids.tolist(), v.scores.tolist(), strict=True))
    worst = float(v.scores.min()) - pieces.BYTE_PENALTY
    texts = ["The quick brown fox jumps over the lazy dog's  back.", "Größe über Straßen – «naïve» café, 12,345.67!", "def f(x):\n\treturn x ** 2  # Quadrat", "\U0001f600 漢字 кириллица", "a", "antidisestablishmentarianism" * 3]
    texts += [t for _, t in edge_cases() if t and t.strip() and len(t) < 1000]
    automaton = Automaton(v)
    for first, end, data, offsets in text_blocks(pa.array(texts)):
        tokens, bounds = encode_block(automaton, data, offsets)
        for i in range(first, end):
            raw = (" " + texts[i]).replace("▁", "\x00").encode().replace(b" ", pieces.MARK)  # a literal mark is no piece
            best = [0.0] + [-np.inf] * len(raw)
            for e in range(1, len(raw) + 1):
                best[e] = max([best[e - 1] + worst, *(best[b] + score[raw[b:e]] for b in range(max(0, e - longest), e) if raw[b:e] in score)])
            own = tokens[bounds[i - first] : bounds[i - first + 1]].tolist()
            if "▁" not in texts[i]:
                assert sum(by_id.get(t, worst) for t in own) == pytest.approx(best[-1]), texts[i]


def test_ranks_become_log_probabilities():
    assert pieces.log_probabilities(np.array([0.0, -1.0, -9.0, -1e9])).tolist() == pytest.approx([0, -np.log(2), -np.log(5), -np.log(5)])
    assert pieces.log_probabilities(np.array([-1.5, -2.0])).tolist() == [-1.5, -2.0]


@needs_model
def test_round_trip(spark):
    data = edge_cases() + [(20, "▁mark  two spaces "), (21, " \U0001f469‍\U0001f4bb\x00 tab\t"), (22, "x" * 5000)]
    tokens = encode_texts(documents(spark, data))
    back = sorted(((r.doc_id, r.text, r.n_tokens, None if r.ids is None else len(r.ids)) for r in decode_tokens(tokens).collect()), key=str)
    assert [(i, t) for i, t, *_ in back] == sorted(data, key=str)
    assert all(n == (m or 0) for _, _, n, m in back) and next(m for i, _, _, m in back if i == 1) is None
    assert encode_texts(documents(spark, [])).isEmpty()
