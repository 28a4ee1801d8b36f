import random
import re
from collections import Counter, defaultdict

from stratum.llm.queries import divergence_rows
from stratum.llm.source_divergence import audit_sources

from .common import CLASHES, LOWER


def plain(rows, min_docs, top):
    """The contract's rows, term by term."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in ((t or "", la or "", s or "") for t, la, s in rows):
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        peers = [s for la, s in groups if la == lang]

        def share(n, total):
            return 1 + 1_000_000_000 * (n + 5) // (total + 5 * len(kept))

        def p(s):
            total = sum(counts[lang, s][t] for t in kept)
            return {t: share(counts[lang, s][t], total) for t in kept}

        own = p(source)
        found = sorted(((sum(abs(own[t] - q) for t, q in p(s).items()), s) for s in peers if s != source), key=lambda x: (-x[0], x[1].encode()))
        out |= {(lang, source, "pair", s, f, i) for i, (f, s) in enumerate(found, 1)}
        total = sum(counts[lang, s][t] for s in peers for t in kept)
        q = {t: share(sum(counts[lang, s][t] for s in peers), total) for t in kept}
        over = sorted(((own[t] - q[t], t) for t in kept if counts[lang, source][t] and own[t] > q[t]), key=lambda x: (-x[0], x[1].encode()))[:top]
        out |= {(lang, source, "term", t, f, i) for i, (f, t) in enumerate(over, 1)}
    return out


def frame(spark, rows):
    schema = "text string, lang string, source string, doc_id long" + "".join(f", {c} string" for c in CLASHES)
    return spark.createDataFrame([(*r, None, *(None,) * len(CLASHES)) for r in rows], schema).repartition(3)


def compare(spark, rows, min_docs, top):
    got = [tuple(r) for r in divergence_rows(audit_sources(frame(spark, rows), min_docs, top)).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, min_docs, top)
    return got


def test_all_rows_match_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["ab", "Ab", "Straße", "é", "漢字", "\U0001f600x", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = [(" ".join(rng.choice(vocabulary[(i % 3) :]) + rng.choice(["", ".", "1", "-y"]) for _ in range(rng.randrange(0, 40))), rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "ä", None, "Z"])) for i in range(120)]
    rows += [("ab " * 50_000, "en", "long"), (None, "en", "silent"), ("", "xx", "alone"), (None, "yy", "p"), ("seldom", "yy", "q")] + [rows[0]] * 5
    got = compare(spark, rows, 5, 4)
    assert {(r[0], r[4]) for r in got if r[0] == "yy"} == {("yy", 0)}  # nothing kept: pairs of value 0
    assert not [r for r in got if r[0] == "xx"]  # a language of one source has no pairs
    assert [r for r in got if r[1] == "silent" and r[2] == "pair"] and not [r for r in got if r[1] == "silent" and r[2] == "term"]


def test_ties_go_by_the_bytes_of_items(spark):
    rows = [(t, "en", s) for s, t in (("a", "é zz a"), ("b", "other thing"), ("c", "other thing"), ("ä", "other thing")) for _ in range(3)]
    got = compare(spark, rows, 3, 2)
    assert [r[3] for r in sorted(got, key=lambda r: r[5]) if r[1] == "a" and r[2] == "term"] == ["a", "zz"]
    assert [r[3] for r in sorted(got, key=lambda r: r[5]) if r[1] == "a" and r[2] == "pair"] == ["b", "c", "ä"]


def test_empty_table(spark):
    audit = audit_sources(frame(spark, []))
    assert divergence_rows(audit).isEmpty() and audit.groups.isEmpty()


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    from stratum.llm.source_divergence import _share

    n, total, kept = 30_000_000_000_000, 70_000_000_000_001, 12_345_678
    got = spark.range(1).select(_share(F.lit(n), F.lit(total), F.lit(kept).cast("long"))).first()[0]
    assert got == 1 + 1_000_000_000 * (n + 5) // (total + 5 * kept)
