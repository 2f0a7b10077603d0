"""The registered queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from auditloom.llm import bpe, decontam, divergence, graph, langid, pii, rtree, sharding, template, topk, toxicity, warc
from auditloom.llm.common import table
from auditloom.llm.neardup import near_duplicates


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(F.expr(f"filter(base, s -> s.kind = '{kind}')")).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text("base"), 256).alias("base_sha256"), pii.spans_text("spans").alias("spans"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2).select("doc_id", "n_shingles", "component_id", "kept")


def op3_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.captures(table(spark, sf_dir, "pages"))


def op4_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                       public_tokenizers.PATTERN, decode=True)
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(documents, labels.where(~toxicity.held_out()))
    return toxicity.predict(documents, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), count=24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    net = langid.fit(documents.where(~langid.held_out()))
    return langid.predict(documents, net).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.nearest(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rtree.hard_negatives(vectors.withColumn("label", moved), every=100, positives=5, negatives=10, scale=256, low=30, high=90)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"), least_df=3, top=200)


QUERIES = {f.__name__: f for f in (
    op1_personal_data, op2_near_duplicates, op3_captures, op4_byte_pairs, op5_nearest, op6_toxicity, op7_decontamination,
    op8_main_text, op9_shards, op10_language, op11_neighbours, op12_hard_negatives, op13_source_divergence)}

_WORD_SETS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [w[1]]
                      ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words),
"""

SQL = {
    "op2_near_duplicates": _WORD_SETS + """
sized AS (SELECT doc_id, s, len(s) AS n FROM sets),
items AS (SELECT doc_id, n, unnest(s) AS x FROM sized),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS nu, any_value(b.n) AS nv, count(*) AS shared
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY 1, 2),
links AS (SELECT u, v FROM common WHERE 100 * shared >= 80 * (nu + nv - shared)),
sides AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT doc_id AS u, doc_id AS r FROM sized UNION SELECT sides.v, reach.r FROM reach JOIN sides ON sides.u = reach.u),
root AS (SELECT u, min(r) AS component_id FROM reach GROUP BY u)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN root ON u = doc_id
""",
    "op7_decontamination": r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM starts),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw JOIN sizes ON len(w) >= k),
found AS (
  SELECT doc_id, i, p.k, item_id FROM places p JOIN windows v ON v.k = p.k AND v.g = array_to_string(w[i:i + p.k - 1], ' ')),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op5_nearest": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op3_captures": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS origin FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         (CAST('0x' || substr(h, 1 + 10 * (i // 8), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31 AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = origin THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> origin THEN origin END AS refers_to
FROM d
""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positives JOIN scored n USING (anchor_id)
  WHERE NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
""",
    "op13_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
w AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS whole FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(whole) AS lang_n FROM kept GROUP BY lang),
cells AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(c) AS n FROM cells GROUP BY ALL),
groups AS (SELECT g.lang, g.source, coalesce(n, 0) AS n, coalesce(v, 0) AS v, lang_n
           FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN sums USING (lang, source) LEFT JOIN langs USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, 1 + (1000000000 * (coalesce(c, 0) + 1)) // (n + v) AS p,
             1 + (1000000000 * (whole + 1)) // (lang_n + v) AS q
      FROM groups g JOIN kept k USING (lang) LEFT JOIN cells USING (lang, source, term)),
sides AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sides s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE c > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts
QUALIFY part = 'pair' OR rank <= 200
""",
}
