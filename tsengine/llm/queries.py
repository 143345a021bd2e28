"""Registered queries of the training-data operators.

Each query applies one operator, with production parameters, to its whole
table and derives the agreed columns from the operator's own output.
``ORACLE_SQL`` has DuckDB SQL where SQL can express the result; the other
queries are tested against brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsengine.llm import (decontaminate, html_text, kneser_ney, language_id, merkle, near_dup, piece_sampling,
                          private_spans, quality, token_counts, topk, url_filter, variants)
from tsengine.llm._common import bound_batches, save_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key) -> F.Column:
    """crc32 of the id as text, mod 5, is 1 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 1


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document: place, fingerprint distance, similarity."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document; ``n_*`` count the base spans, ``n_added``
    the model's."""
    docs = _table(spark, sf_dir, "documents")
    found = private_spans.detect(docs, private_spans.fit(docs))
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in private_spans.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by line, crossing tokens going to the line with most of them."""
    counted = token_counts.count_tokens(_table(spark, sf_dir, "documents"), rule="largest")
    return counted.select("doc_id", "n_tokens", "n_bytes", F.size("sections").cast("long").alias("n_sections"), "sections")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney scores of every document under the model of the training fold."""
    docs = _table(spark, sf_dir, "documents")
    model = kneser_ney.fit(docs, "text", ~held_out(docs["doc_id"]))
    scored = kneser_ney.perplexity(kneser_ney.score(docs, model, "doc_id", "text"))
    return scored.select(F.col("key").alias("doc_id"), held_out(F.col("key")).alias("held_out"), "n_tokens",
                         "n_known", "train_tokens", "base_score", "score", "perplexity")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingle classes of every document at a similarity of 0.8."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), "doc_id", "text", k=2, percent=80)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, listed rule and verdict of every page's URL."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document (declared label, source as host) and of
    every page (markup, address suffix, host), under one text model."""
    docs, pages = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages")
    model = language_id.fit_text(docs)
    judged = language_id.classify(docs.select("doc_id", "text", "lang", "source"), model, "text",
                                  declared=docs["lang"], host=docs["source"])
    evidence = language_id.page_evidence(pages)
    rows = pages.select("page_id", *[c.alias(n) for n, c in evidence.items()])
    page = language_id.classify(rows, model, "text", rows["declared"], rows["suffix"], rows["host"], rows["domain"])
    out = ("language", "language_p", "accepted")
    none = F.lit(None).cast("long")
    return (judged.select("doc_id", none.alias("page_id"), *out)
            .unionByName(page.select(none.alias("doc_id"), "page_id", *out)))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentation of every document and whether decoding restores it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = piece_sampling.encode(docs, "doc_id", "text", decoded="decoded")
    return coded.select("doc_id", F.length("text").cast("long").alias("n_chars"),
                        F.size("pieces").cast("long").alias("n_pieces"), F.xxhash64("pieces").alias("pieces_hash"),
                        (F.col("decoded") == F.col("text")).alias("lossless"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = html_text.extract(_table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every query vector (id divisible by 50)."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, k=5)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inclusion proofs of every document, and which ones still lead to the root
    after the tampering."""
    docs = _table(spark, sf_dir, "documents")

    def leaf(text):
        return merkle.leaf_digest(docs["doc_id"], docs["source"], docs["lang"], docs["n_chars"], text)

    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    hit = F.crc32(docs["doc_id"].cast("string")) % 3 == 0
    manifest = merkle.build(docs, "lang", "doc_id", leaf(docs["text"]), changed=F.when(hit, leaf(lower)))
    folded = merkle.fold(F.coalesce("payload.changed", "digest"), F.col("path"))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    out = merkle.proofs(manifest).select(
        F.col("payload.key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot",
        F.lit(manifest.root).alias("root"), F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document under the rules learnt from the training labels."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")

    def out(key):  # a null id counts as empty text
        return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 0

    model = quality.fit(docs, labels, ~out(F.col("key")))
    scored = quality.score(docs, model, "text", {"doc_id": docs["doc_id"], "held_out": out(docs["doc_id"])})
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, forms and roots of every frequent word, with planted misspellings."""
    runs = variants.runs(_table(spark, sf_dir, "documents"), "doc_id", "text", variants.MIN_LENGTH)
    words = variants.count_words(runs.select(variants.damaged(F.col("id"), F.col("run"), 199).alias("word")))
    return variants.group(save_table(words, "vocabulary"))


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_pii": op2_pii,
    "op3_token_counts": op3_token_counts,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_url_filters": op5_url_filters,
    "op6_language_id": op6_language_id,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_html_extraction": op9_html_extraction,
    "op10_exact_topk": op10_exact_topk,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_spelling_variants": op13_spelling_variants,
}

# Every pair of documents that share a shingle, then reachability by id.
_OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
        ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END)) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g
      JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
      WHERE a.doc_id <> b.doc_id AND least(na.n, nb.n) * 100 >= 80 * greatest(na.n, nb.n)
      GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS c FROM d UNION SELECT e.a, r.c FROM r JOIN e ON e.b = r.a AND r.c < e.a),
m AS (SELECT a, min(c) AS c FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d JOIN m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

_OP10_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
           FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5"""

# crc32 of ASCII text: the byte table from its rule, then a fold over the characters.
_CRC_SQL = """
bits AS (SELECT list_transform(range(256), lambda v: list_reduce([CAST(v AS BIGINT), 1, 1, 1, 1, 1, 1, 1, 1],
           lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc(codes: str) -> str:
    return (f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), "
            "lambda c, b: xor(t[CAST(xor(c, b) & 255 AS INTEGER) + 1], c >> 8)))")


def _framed_sql(*fields: str) -> str:
    return " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields)


_LOWER_SQL = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_RUNS_SQL = "list_transform(range(CAST((len(h) + 7) // 8 AS BIGINT)), lambda k: sha256(array_to_string(h[k * 8 + 1 : k * 8 + 8], '')))"

# The levels of every tree as lists, from the leaves up; then proofs level by level.
_OP11_SQL = f"""
WITH RECURSIVE {_CRC_SQL.strip()},
d AS (SELECT doc_id, lang, sha256({_framed_sql('doc_id', 'source', 'lang', 'n_chars', 'text')}) AS leaf,
             CASE WHEN {_crc("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")} % 3 = 0
                  THEN sha256({_framed_sql('doc_id', 'source', 'lang', 'n_chars', _LOWER_SQL)}) END AS changed
      FROM documents, bits),
e AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
l AS (SELECT lang, 0 AS level, list(leaf ORDER BY i) AS h FROM e GROUP BY lang
      UNION ALL SELECT lang, level + 1, {_RUNS_SQL} FROM l WHERE len(h) > 1),
s AS (SELECT lang, h[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM l WHERE len(h) = 1),
t AS (SELECT 0 AS level, list(subroot ORDER BY i) AS h FROM s
      UNION ALL SELECT level + 1, {_RUNS_SQL} FROM t WHERE len(h) > 1),
r AS (SELECT h[1] AS root FROM t WHERE len(h) = 1),
p AS (SELECT e.doc_id, e.lang, e.leaf, CAST(0 AS BIGINT) AS step, CAST(e.i AS BIGINT) AS i, '' AS proof,
             coalesce(e.changed, e.leaf) AS node, false AS top FROM e
      UNION ALL
      SELECT p.doc_id, p.lang, p.leaf, CASE WHEN p.top OR len(l.h) > 1 THEN p.step + 1 ELSE 0 END,
             CASE WHEN p.top OR len(l.h) > 1 THEN p.i // 8 ELSE s.i END,
             p.proof || CASE WHEN p.top THEN array_to_string(t.h[p.i // 8 * 8 + 1 : p.i], '') || array_to_string(t.h[p.i + 2 : p.i // 8 * 8 + 8], '')
                             WHEN len(l.h) > 1 THEN array_to_string(l.h[p.i // 8 * 8 + 1 : p.i], '') || array_to_string(l.h[p.i + 2 : p.i // 8 * 8 + 8], '')
                             ELSE '' END,
             CASE WHEN p.top THEN sha256(array_to_string(t.h[p.i // 8 * 8 + 1 : p.i], '') || p.node || array_to_string(t.h[p.i + 2 : p.i // 8 * 8 + 8], ''))
                  WHEN len(l.h) > 1 THEN sha256(array_to_string(l.h[p.i // 8 * 8 + 1 : p.i], '') || p.node || array_to_string(l.h[p.i + 2 : p.i // 8 * 8 + 8], ''))
                  ELSE p.node END,
             p.top OR len(l.h) = 1
      FROM p LEFT JOIN l ON NOT p.top AND l.lang IS NOT DISTINCT FROM p.lang AND l.level = p.step
             LEFT JOIN s ON s.lang IS NOT DISTINCT FROM p.lang
             LEFT JOIN t ON p.top AND t.level = p.step
      WHERE NOT p.top OR len(t.h) > 1)
SELECT p.doc_id, p.leaf, s.subroot, r.root, sha256(p.proof) AS proof_sha256, p.node AS folded_root, p.node = r.root AS verified
FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang JOIN t ON t.level = p.step AND len(t.h) = 1 CROSS JOIN r WHERE p.top"""

# Near words by their deletions: a replaced point leaves both words equal without it,
# an inserted one leaves the longer word without it equal to the shorter.
_OP13_SQL = f"""
WITH RECURSIVE {_CRC_SQL.strip()},
o AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')),
             '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS w FROM documents WHERE text IS NOT NULL),
g AS (SELECT doc_id, w, count(*) AS n FROM o GROUP BY ALL HAVING length(w) >= 6),
c AS (SELECT w, n, {_crc("flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''), lambda x: "
                         "CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, 128 + (unicode(x) & 63)] END))")} AS h
      FROM g, bits),
v AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word,
             CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
x AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
      FROM v, unnest(range(1, length(word) + 1)) AS u(i)),
p AS (SELECT a.word, b.word AS other FROM x a JOIN x b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
      UNION SELECT v.word, x.word FROM v JOIN x ON x.less = v.word
      UNION SELECT x.word, v.word FROM v JOIN x ON x.less = v.word),
f AS (SELECT p.word, p.other, o.n AS m, count(*) OVER (PARTITION BY p.word) AS n_near,
             row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, encode(p.other)) AS k
      FROM p JOIN v o ON o.word = p.other),
r AS (SELECT v.word, v.n, coalesce(f.n_near, 0) AS n_near, CASE WHEN f.m >= 5 * v.n THEN f.other END AS form,
             CASE WHEN f.m >= 5 * v.n THEN f.m END AS form_n FROM v LEFT JOIN f ON f.word = v.word AND f.k = 1),
t AS (SELECT word, word AS at FROM r UNION ALL SELECT t.word, r.form FROM t JOIN r ON r.word = t.at WHERE r.form IS NOT NULL)
SELECT r.word, r.form, t.at AS root, r.n, r.n_near, r.form_n
FROM r JOIN t ON t.word = r.word JOIN r z ON z.word = t.at AND z.form IS NULL"""

ORACLE_SQL: dict[str, str] = {
    "op5_url_filters": url_filter.oracle_sql(),
    "op8_minhash_near_dedup": _OP8_SQL,
    "op10_exact_topk": _OP10_SQL,
    "op11_merkle_manifest": _OP11_SQL,
    "op13_spelling_variants": _OP13_SQL,
}
