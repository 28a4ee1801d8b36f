"""The registered queries `opN_<name>`: thin callers of the operators.

Every query takes (spark, sf_dir), applies one operator with its production
parameters to the whole of its table, and derives the columns that the
contract of the query names.  `ORACLES` has DuckDB SQL where SQL can express
the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .collocations import LONGEST, MIN_COUNT, NO_LANG, SUBSUMED, TOP, mine_phrases
from .collocations import SCALE as PHRASE_SCALE
from .decontamination import contained_items
from .jaccard_join import near_duplicate_components
from .license_scan import BASE_PHRASES, BODY_K, COVERAGE, NOTICE_K, NOTICES, PHRASE_K, SHIFT, SHIFT_SHARE, license_bodies, scan_licenses, template_words
from .line_dedup import dedup_lines
from .lm_scoring import score_texts
from .pieces import decode_tokens, encode_texts
from .pii import pseudonymize
from .quality_classifier import classify
from .sharding import ShardStore
from .source_divergence import MIN_DOCS, SCALE, SMOOTHING, TOP_TERMS, Audit, audit_sources
from .support import Scratch, crc32_mod
from .token_records import read_token_records, write_token_records
from .topk import top_k

#: Key of the registered query only; callers of the operator bring their own.
DEMO_KEY = b"registered query, not a secret"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as read back from a compacted store.

    They arrive as four large deliveries and 32 small ones (a hash of the id
    tells them apart), each a run of small shards before the compaction; both
    kinds fill a tier, so every row is merged.
    """
    docs = _table(spark, sf_dir, "documents")
    store = ShardStore(spark, Scratch(spark, "shards").root, docs.schema)
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    store.append_each(docs, F.when(dealt < 32, F.floor(dealt / 8)).otherwise(dealt))
    store.compact()
    store.vacuum()
    return store.read()


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); a row without an id is not held out."""
    scored = score_texts(_table(spark, sf_dir, "documents"), crc32_mod("doc_id", 5) != 1)
    held_out = F.coalesce(crc32_mod("doc_id", 5) == 1, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_md5): token ids of each text, and the digest of their decoding."""
    tokens = encode_texts(_table(spark, sf_dir, "documents"))
    return decode_tokens(tokens).select("doc_id", "n_tokens", "ids", F.md5(F.encode("text", "UTF-8")).alias("decoded_md5"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_shingles, component_id)."""
    return near_duplicate_components(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, held_out, score, predicted); a row without an id is not held out."""
    scored = classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), crc32_mod("doc_id", 4) != 2)
    held_out = F.coalesce(crc32_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, rank, vec_id, score)."""
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_common, containment) of each contained item."""
    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans)."""
    found = scan_licenses(_table(spark, sf_dir, "documents"))
    starts = F.transform("phrase_starts", lambda x: x["start"])
    base = F.array_distinct(F.transform("phrase_starts", lambda x: x["label"]))
    own = F.transform("spans", lambda x: x["label"])
    best = F.coalesce(F.array_max(F.transform("spans", lambda x: x["coverage"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrase_starts").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.when(F.size("phrase_starts") > 0, F.greatest(best, F.lit(0.5))).otherwise(best).alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_found, kinds, text): texts with pseudonyms."""
    found = pseudonymize(_table(spark, sf_dir, "documents"), DEMO_KEY)
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("spans", lambda x: x["kind"]))), ",")
    return found.select("doc_id", F.size("spans").cast("long").alias("n_found"), kinds.alias("kinds"), "text")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_lines, n_removed_lines, n_removed_chunks, text)."""
    return dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", "text")


def op11_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each record, as read back from the files."""
    folder = Scratch(spark, "records").path("tokens")
    write_token_records(_table(spark, sf_dir, "documents"), folder)
    return read_token_records(spark, folder, ("doc_id", "start", "n_tokens", "ids_crc32"))


def divergence_rows(audit: Audit) -> DataFrame:
    """Both parts of an audit in one table, ranked."""
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = audit.pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value").withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(audit.terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, source, part, item, value, rank): sources by their distance, and the terms that a source has in excess."""
    return divergence_rows(audit_sources(_table(spark, sf_dir, "documents")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the highest-scoring phrases of each language."""
    return mine_phrases(_table(spark, sf_dir, "documents")).top


QUERIES = {f.__name__: f for f in (op1_sharding, op2_lm_scoring, op3_sentencepiece, op4_jaccard_join, op5_quality, op6_topk, op7_decontamination, op8_licenses, op9_pii, op10_line_dedup, op11_token_records, op12_divergence, op13_collocations)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + ", '[^\\x20\\x09-\\x0D]+')"

_ALNUM = "regexp_extract_all(" + _LOWER + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _license_sql() -> str:
    """The license scan in SQL: grams by their words, votes by diagonal, neighbouring diagonals merged."""
    classes = ((PHRASE_K, BASE_PHRASES), (NOTICE_K, NOTICES), (BODY_K, license_bodies()))
    rows = ", ".join(f"({k}, {i}, '{t.label}', '{' '.join(template_words(t))}')" for k, templates in classes for i, t in enumerate(templates))
    return f"""
        WITH t AS (SELECT k, template, label, string_split(words, ' ') AS w, len(string_split(words, ' ')) - k + 1 AS size FROM (VALUES {rows}) AS x(k, template, label, words)),
        tg AS (SELECT k, template, pos, array_to_string(w[pos + 1:pos + k], ' ') AS gram FROM (SELECT *, unnest(range(size)) AS pos FROM t)),
        d AS (SELECT doc_id, {_ALNUM.format("coalesce(text, '')")} AS w FROM documents),
        dg AS (SELECT doc_id, k, i, array_to_string(w[i + 1:i + k], ' ') AS gram FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM t))),
        v AS (SELECT doc_id, tg.k, template, pos, i, i - pos AS diagonal FROM dg JOIN tg ON tg.k = dg.k AND tg.gram = dg.gram),
        b AS (SELECT doc_id, diagonal AS start, label FROM (SELECT doc_id, k, template, diagonal, count(DISTINCT pos) AS n FROM v WHERE k = {PHRASE_K} GROUP BY ALL) x JOIN t USING (k, template) WHERE n = size),
        g AS (SELECT doc_id, k, template, diagonal, min(i) AS low, max(i) AS high, list(DISTINCT pos) AS covered FROM v WHERE k <> {PHRASE_K} GROUP BY ALL),
        f AS (SELECT g.*, label, size, CASE WHEN diagonal - lag(diagonal) OVER o <= {SHIFT} + size // {SHIFT_SHARE} AND low - lag(high) OVER o <= size + {SHIFT} + size // {SHIFT_SHARE} THEN 0 ELSE 1 END AS far
              FROM g JOIN t USING (k, template) WINDOW o AS (PARTITION BY doc_id, k, template ORDER BY diagonal, low)),
        m AS (SELECT *, sum(far) OVER (PARTITION BY doc_id, k, template ORDER BY diagonal, low ROWS UNBOUNDED PRECEDING) AS span FROM f),
        s AS (SELECT doc_id, label, len(list_distinct(flatten(list(covered)))) / size AS coverage FROM m GROUP BY doc_id, k, template, label, size, span),
        s2 AS (SELECT * FROM s WHERE coverage >= {COVERAGE}),
        bs AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY 1),
        ls AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM b UNION ALL SELECT doc_id, label FROM s2) GROUP BY 1),
        ss AS (SELECT doc_id, count(*) AS n_spans, max(coverage) AS best FROM s2 GROUP BY 1)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
            cast(CASE WHEN n_base > 0 THEN greatest(coalesce(best, 0), 0.5) ELSE coalesce(best, 0) END AS double) AS score, coalesce(n_spans, 0) AS n_spans
        FROM d LEFT JOIN bs USING (doc_id) LEFT JOIN ls USING (doc_id) LEFT JOIN ss USING (doc_id)
    """


_LETTERS = "regexp_extract_all(" + _LOWER + ", '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op13_collocations": f"""
        WITH p AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
        n AS (SELECT lang, cast(sum(len(w)) AS bigint) AS n FROM w GROUP BY 1),
        f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, {LONGEST + 1})) AS k)) GROUP BY 1, 2, 3 HAVING count(*) >= {MIN_COUNT}),
        c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
        x AS (SELECT lang, size, phrase, a, w, unnest(range(1, size)) AS k FROM c),
        y AS (SELECT x.lang, x.phrase, x.a, x.k, p.f AS l, q.f AS r, ({PHRASE_SCALE}::HUGEINT * x.a) // (p.f::HUGEINT + q.f) AS score
              FROM x JOIN f p ON p.lang = x.lang AND p.phrase = array_to_string(w[1:x.k], ' ') JOIN f q ON q.lang = x.lang AND q.phrase = array_to_string(w[x.k + 1:], ' ')),
        b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM y) WHERE o = 1),
        s AS (SELECT lang, a, unnest(list_transform(range(1, size - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM (SELECT *, unnest(range(2, size)) AS m FROM c)),
        z AS (SELECT lang, phrase, max(a) AS longer FROM s GROUP BY 1, 2),
        t AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank FROM b LEFT JOIN z ON z.lang = b.lang AND z.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < {SUBSUMED} * b.a)
        SELECT t.lang, rank, phrase, a, l, r, n.n, cast(score AS bigint) AS score FROM t JOIN n ON n.lang = t.lang WHERE rank <= {TOP}
    """,
    "op12_divergence": f"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LETTERS.format("coalesce(text, '')")} AS w FROM documents),
        t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
        kept AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= {MIN_DOCS}),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
        c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY 1, 2, 3),
        g AS (SELECT DISTINCT lang, source FROM d),
        x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        y AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(n) OVER (PARTITION BY lang) AS all_total, sum(n) OVER (PARTITION BY lang, term) AS all_n FROM x),
        p AS (SELECT lang, source, term, n, 1 + ({SCALE}::HUGEINT * (n + {SMOOTHING})::HUGEINT) // (total + {SMOOTHING} * v.v)::HUGEINT AS p,
                     1 + ({SCALE}::HUGEINT * (all_n + {SMOOTHING})::HUGEINT) // (all_total + {SMOOTHING} * v.v)::HUGEINT AS q FROM y JOIN v USING (lang)),
        pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
        r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, cast(coalesce(f, 0) AS bigint) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN pairs s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
              UNION ALL SELECT lang, source, 'term', term, cast(p - q AS bigint) FROM p WHERE n > 0 AND p > q),
        o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rn FROM r)
        SELECT lang, source, part, item, value, cast(rn AS int) AS rank FROM o WHERE part = 'pair' OR rn <= {TOP_TERMS}
    """,
    "op8_licenses": _license_sql(),
    "op4_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM d WHERE len(w) > 0),
        n AS (SELECT d.doc_id, count(g) AS n FROM d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY 1),
        c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_ FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * both_ >= 75 * (p.n + q.n - both_)),
        e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
        r AS (SELECT doc_id, doc_id AS reached FROM d UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached)
        SELECT r.doc_id, any_value(n.n) AS n_shingles, min(reached) AS component_id FROM r JOIN n ON n.doc_id = r.doc_id GROUP BY 1
    """,
    "op7_decontamination": f"""
        WITH i AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
        s AS (SELECT DISTINCT item_id, least(len(w), 5) AS k, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda j: array_to_string(w[j:j + 4], ' '))) AS g FROM i WHERE len(w) > 0),
        n AS (SELECT item_id, count(*) AS n_shingles FROM s GROUP BY 1),
        d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
        t AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS g FROM d, (SELECT DISTINCT k FROM s) WHERE len(w) >= k)
        SELECT doc_id, s.item_id, n_shingles, count(*) AS n_common, count(*) / n_shingles AS containment
        FROM t JOIN s ON s.k = t.k AND s.g = t.g JOIN n ON n.item_id = s.item_id GROUP BY doc_id, s.item_id, n_shingles HAVING count(*) * 100 >= 75 * n_shingles
    """,
    "op10_line_dedup": """
        WITH b AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL AND text <> ''),
        d AS (SELECT doc_id, len(l) > 1 AND l[-1] = '' AS tail, CASE WHEN len(l) > 1 AND l[-1] = '' THEN l[:-2] ELSE l END AS l FROM b),
        lines AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM d),
        c AS (SELECT doc_id, i, l[i] || chr(10) || l[i + 1] AS body FROM (SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM d)),
        f AS (SELECT body, min((doc_id, i)) AS first FROM c GROUP BY 1),
        gone AS (SELECT c.doc_id, c.i FROM c JOIN f ON f.body = c.body WHERE (c.doc_id, c.i) <> f.first),
        g AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, i FROM gone UNION ALL SELECT doc_id, i + 1 FROM gone)),
        k AS (SELECT lines.doc_id, count(*) AS n_lines, count(g.i) AS n_removed, string_agg(CASE WHEN g.i IS NULL THEN line END, chr(10) ORDER BY lines.i) AS kept
              FROM lines LEFT JOIN g ON g.doc_id = lines.doc_id AND g.i = lines.i GROUP BY 1),
        m AS (SELECT doc_id, count(*) AS n_chunks FROM gone GROUP BY 1)
        SELECT o.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed_lines, coalesce(n_chunks, 0) AS n_removed_chunks,
            CASE WHEN coalesce(n_removed, 0) = 0 THEN o.text WHEN n_removed = n_lines THEN '' ELSE kept || CASE WHEN tail THEN chr(10) ELSE '' END END AS text
        FROM documents o LEFT JOIN d ON d.doc_id = o.doc_id LEFT JOIN k ON k.doc_id = o.doc_id LEFT JOIN m ON m.doc_id = o.doc_id
    """,
    "op1_sharding": "SELECT * FROM documents",
    "op6_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x AS double)) AS bigint)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS bigint) AS score
              FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM s)
        SELECT query_id, cast(rn AS int) AS rank, vec_id, score FROM r WHERE rn <= 20
    """,
}
