"""The registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popflow.llm import (
    ann, audit, cascade, importance, inner_products, mixing, near_dup, ngram_lm, pieces,
    pu_quality, shuffle, templates, toxicity,
)
from popflow.llm.common import bucket_of, n_words_of

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        _queries[name] = fn
        if sql is not None:
            _sql[name] = sql
        return fn
    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- sharding

def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("bigint")


@query("op3_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", size_of(F.col("text")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    dealt = shuffle.shuffle_to_shards(docs, 40, ["doc_id", "text_crc32", "size"], seed=3)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


# --- quality rules

_RULES_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))
               AS lines,
             len(string_split(t, chr(10))) AS n_lines FROM d),
k AS (SELECT *, len(w) AS n,
             CASE WHEN len(w) < 5 THEN []::VARCHAR[] ELSE
               list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END AS g
      FROM w),
e AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, window_words) AS times FROM (
        SELECT doc_id, unnest(g) AS window_words, unnest(range(1, len(g) + 1)) AS pos FROM k)),
p AS (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before
      FROM e WHERE times > 1),
r AS (SELECT doc_id, sum(least(5, coalesce(pos - before, 5))) AS n FROM p GROUP BY doc_id),
m AS (SELECT k.doc_id, k.n AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words, n_lines,
        len(list_filter(range(2, k.n + 1), lambda i: w[i] = w[i - 1])) AS n_stutters,
        length(regexp_replace(t, '\P{L}+', '', 'g')) AS letters,
        length(regexp_replace(t, '\P{Lu}+', '', 'g')) AS uppers
      FROM k LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * uppers > letters
       OR 5 * n_stutters > n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM b"""


@query("op4_quality_rules", _RULES_SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    base = {m.__name__: m for m in (
        cascade.n_words, cascade.word_chars, cascade.n_symbols, cascade.n_dup_lines,
        cascade.n_repeat_words)}
    measured = docs.withColumns({name: m(F.col("text")) for name, m in base.items()})
    judged = cascade.apply_rules(measured, measures={name: F.col(name) for name in base})
    failed = (cascade.too_short(F.col("n_words"))
              | cascade.too_repetitive(F.col("n_repeat_words"), F.col("n_words")))
    return judged.select("doc_id", *base, failed.alias("base_failed"),
                         F.col("broken_rule").isNull().alias("kept"))


# --- toxicity

@query("op6_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = bucket_of(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


# --- mixing

@query("op7_mixing", """
WITH d AS (SELECT doc_id, source, coalesce('=' || source, '') AS name,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS tie FROM documents),
s AS (SELECT source, name, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n
      FROM d GROUP BY ALL),
v AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
      + 1 AS INTEGER)] AS weight, CAST(source_size AS DOUBLE) * 3 AS cap FROM s),
l AS (SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER ()
        - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM v),
o AS (SELECT level FROM l WHERE level * weight <= cap
      ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (SELECT l.name, l.source_size, least(cap, coalesce(o.level * weight, cap)) AS target,
        CAST(('0x' || substr(md5('mix|' || l.name), 1, 12)) AS BIGINT) / 281474976710656.0::DOUBLE
          AS off,
        (n + 4095) // 4096 AS parts
      FROM l LEFT JOIN o ON true),
r AS (SELECT d.*, t.source_size, t.target, t.off,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS step,
        row_number() OVER (PARTITION BY name
          ORDER BY CAST(('0x' || substr(tie, 1, 12)) AS BIGINT) % parts, size, tie) - 1 AS rank
      FROM d JOIN t USING (name))
SELECT doc_id, size, source_size, target,
  CAST(size * least(3, floor((rank + 1) * step + off) - floor(rank * step + off)) AS BIGINT) AS taken
FROM r""")
def mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", n_words_of(F.col("text")).alias("size"))
    mixed = mixing.mix_sources(docs, "size")
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


# --- quality classifier

@query("op8_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = bucket_of(F.col("doc_id"), 4) == 2
    network = pu_quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return pu_quality.score(docs, network).select(
        "doc_id", held_out.alias("held_out"), F.col("goodness").alias("score"),
        (F.col("goodness") >= 0.7).cast("int").alias("predicted"))


# --- HTML extraction

@query("op2_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return templates.extract(pages).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


# --- approximate nearest neighbours

@query("op5_nearest_neighbours")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dim = ann.valid_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    is_query = F.col("id") % 50 == 0
    return ann.search(ann.build(rows, dim, is_query), is_query)


# --- near duplicates

@query("op9_near_duplicates")
def near_duplicate_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classes = near_dup.near_duplicates(docs, idf="every")
    return near_dup.with_class(docs, classes).select("doc_id", "class_id", "class_rows")


# --- SentencePiece

@query("op10_sentencepiece")
def sentencepiece_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.load(pieces.default_model())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    return coded.select(
        "doc_id", F.size("pieces").cast("bigint").alias("n_pieces"), "pieces",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


# --- language-model scores

@query("op1_lm_scores")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = bucket_of(F.col("doc_id"), 5) == 1
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", held_out.alias("held_out"))
    return ngram_lm.score_documents(docs, ~F.col("held_out")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


# --- filter interaction audit

_AUDIT_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT doc_id, part,
    len(w) < 200 AS A, 100 * len(list_distinct(w)) < 50 * len(w) AS B,
    100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) AS C,
    regexp_matches(t, '[#$%&*|]') AS D,
    coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS E FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, concat(CASE WHEN A THEN 'A' ELSE '' END, CASE WHEN B THEN 'B' ELSE '' END,
        CASE WHEN C THEN 'C' ELSE '' END, CASE WHEN D THEN 'D' ELSE '' END,
        CASE WHEN E THEN 'E' ELSE '' END) AS failed,
        coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM f LEFT JOIN l USING (doc_id)),
c AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
      FROM m GROUP BY part, failed),
p AS (SELECT '' AS o UNION ALL
      SELECT p.o || x.f FROM p, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) x
      WHERE NOT contains(p.o, x.f)),
s AS (SELECT o AS filter_order, step, substr(o, step, 1) AS f, substr(o, 1, step - 1) AS earlier
      FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE length(o) = 5),
e AS (SELECT part, filter_order, step, f, n, good, toxic, failed, contains(failed, f) AS hit,
             earlier <> '' AND translate(failed, earlier, '') <> failed AS gone FROM c, s),
g AS (SELECT part, filter_order, step, f,
    sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM e GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM g"""


@query("op13_filter_audit", _AUDIT_SQL)
def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# --- target-distribution importance resampling

_RESAMPLE_SQL = r"""
WITH crc AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
x AS (SELECT 0 AS target, doc_id AS id, row_number() OVER () AS r, coalesce(text, '') AS text
      FROM documents
      UNION ALL SELECT 1, item_id, row_number() OVER (), coalesce(text, '') FROM benchmark),
w AS (SELECT target, r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM (
        SELECT target, r, regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM x)),
b AS (SELECT word, list_transform(range(0, CAST(len(h) / 2 AS BIGINT)),
             lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS bytes
      FROM (SELECT DISTINCT word, hex(encode(word)) AS h FROM w)),
s1 AS (SELECT target, r, pos, bytes, list_reduce(bytes,
         lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), 4294967295) AS s1
       FROM w JOIN b USING (word), crc),
s2 AS (SELECT s1.*, list_reduce(list_prepend(32, bytes),
         lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), p) AS s2
       FROM (SELECT *, lag(s1) OVER (PARTITION BY target, r ORDER BY pos) AS p FROM s1) s1, crc),
s3 AS (SELECT s2.*, list_reduce(list_prepend(32, bytes),
         lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), q) AS s3
       FROM (SELECT *, lag(s2) OVER (PARTITION BY target, r ORDER BY pos) AS q FROM s2) s2, crc),
f AS (SELECT target, r, xor(s, 4294967295) % 10000 AS bucket FROM (
        SELECT target, r, s1 AS s FROM s3
        UNION ALL SELECT target, r, s2 FROM s3 WHERE pos > 1
        UNION ALL SELECT target, r, s3 FROM s3 WHERE pos > 2)),
n AS (SELECT bucket, count(*) FILTER (WHERE target = 0) AS s, count(*) FILTER (WHERE target = 1) AS t
      FROM f GROUP BY bucket),
a AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM n),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))
        AS BIGINT) AS gain FROM n, a),
d AS (SELECT r, count(*) AS n_features, sum(gain) AS weight FROM f JOIN g USING (bucket)
      WHERE target = 0 GROUP BY r),
m AS (SELECT r, max(pos) AS n_words FROM w WHERE target = 0 GROUP BY r),
z AS (SELECT x.id AS doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_features, 0) AS n_features,
        coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((
          CAST('0x' || substr(sha256('42:' || coalesce(CAST(x.id AS VARCHAR), '')), 1, 8) AS BIGINT)
          + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
      FROM x LEFT JOIN d USING (r) LEFT JOIN m USING (r) WHERE x.target = 0),
o AS (SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20
        ORDER BY score DESC, doc_id NULLS LAST) END AS place,
        5 * count(*) FILTER (WHERE n_words >= 20) OVER () // 100 AS drawn FROM z)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight,
  CAST(score AS BIGINT) AS score, CAST(CASE WHEN place <= drawn THEN place END AS BIGINT) AS rank
FROM o"""


@query("op11_importance_resampling", _RESAMPLE_SQL)
def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


# --- exact largest inner products

@query("op12_inner_products", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, min(v) AS q FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id),
s AS (SELECT query_id, vec_id, CAST(list_inner_product(q, v) AS BIGINT) AS score
      FROM q JOIN v ON vec_id <> query_id)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5""")
def largest_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inner_products.whole_vectors(
        table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return inner_products.top_products(rows, F.col("id") % 50 == 0)
