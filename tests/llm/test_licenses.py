import random
import re

from stratum.llm.license_scan import BASE_PHRASES, NOTICES, Template, license_bodies, scan_licenses, template_words

from .common import LOWER, documents, edge_cases, prose


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def places(text):
    w = tokens(text)
    return sorted((i, t.label) for t in BASE_PHRASES for i in range(len(w)) if w[i : i + len(t.text.split())] == t.text.split())


def scanned(spark, rows, **templates):
    return sorted(scan_licenses(documents(spark, rows), **templates).collect(), key=lambda r: (str(r.doc_id), r.n_words))


def test_phrases_match_brute_force(spark):
    rng = random.Random(1)
    rows = edge_cases()
    for i in range(100, 140):
        w = prose(rng, rng.randrange(30)).split()
        for _ in range(rng.randrange(4)):
            w.insert(rng.randrange(len(w) + 1), rng.choice(["MIT License.", "Apache, License", "cc-by", "GNU General Public License", "gnu general public", "mit mit license license", "cc  by cc by"]))
        rows.append((i, " ".join(w)))
    out = scanned(spark, rows)
    want = sorted(((i, len(tokens(t)), places(t)) for i, t in rows), key=lambda r: (str(r[0]), r[1]))
    assert [(r.doc_id, r.n_words, [tuple(p) for p in r.phrase_starts]) for r in out] == want


def test_spans_bridge_inserted_and_missing_words(spark):
    text = next(t.text for t in NOTICES if t.label == "mit-text")
    w = text.split()
    rows = [(1, text.upper()), (2, " ".join(["x"] * 9 + w[:8] + ["oops"] + w[8:])), (3, " ".join(w[:10] + w[12:])), (4, " ".join(w[:6])), (5, " ".join(reversed(w)))]
    spans = {r.doc_id: [(s.start, s.label) for s in r.spans] for r in scanned(spark, rows)}
    assert spans == {1: [(0, "mit-text")], 2: [(9, "mit-text")], 3: [(0, "mit-text")], 4: [], 5: []}


def test_two_copies_are_two_spans(spark):
    t = Template("own", " ".join(f"v{i}" for i in range(12)))
    gap = " ".join(f"z{i}" for i in range(50))
    (row,) = scanned(spark, [(1, f"{t.text} {gap} {t.text}")], notices=[t], bodies=[])
    assert [(s.start, s.length, s.coverage) for s in row.spans] == [(0, 12, 1.0), (62, 12, 1.0)]


def edited(rng, words, every):
    """Words with one changed, left out or put in at about each `every`-th place."""
    out = []
    for w in words:
        kind = rng.randrange(3 * every)
        out += [] if kind == 0 else ["changed"] if kind == 1 else ["put", "in", w] if kind == 2 else [w]
    return out


def test_whole_licences_are_found_inside_texts_with_edits(spark):
    rng = random.Random(4)
    bodies = license_bodies()
    assert len(bodies) >= 10
    rows, want = [], {}
    for i, t in enumerate(bodies):
        w = template_words(t)
        rows.append((i, prose(rng, 50) + "\n" + t.text.upper() + "\n" + prose(rng, 50)))
        rows.append((100 + i, " ".join(prose(rng, 30).split() + edited(rng, w, 40) + prose(rng, 30).split())))
        rows.append((200 + i, " ".join(w[: len(w) // 2])))
        want |= {i: 50, 100 + i: 30}
    for r in scanned(spark, rows):
        label = bodies[r.doc_id % 100].label
        spans = [s for s in r.spans if s.label == label]
        if r.doc_id < 200:
            body = max(spans, key=lambda s: s.length)  # some texts hold the notice of the same name besides
            assert body.length > 100 and abs(body.start - want[r.doc_id]) < 40, (r.doc_id, label)
            assert body.coverage == 1 or r.doc_id >= 100
        else:
            assert all(s.length < 40 for s in spans), label


def test_no_documents(spark):
    assert scanned(spark, []) == []
