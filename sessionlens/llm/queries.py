"""One query for each corpus operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitsliced_topk, html_extract, near_dedup, pii, quality_classifier, quality_rules, secret_scan, sentencepiece_scan, source_mixing, substring_dedup
from .shared import table

ORACLES: dict[str, str] = {}


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"), config=near_dedup.NearConfig(words=2))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extract.extracted(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "by_template")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.deduplicated(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return done.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = sentencepiece_scan.encoded(table(spark, sf_dir, "documents"))
    ids = F.sha2(F.array_join("token_ids", ","), 256)
    return tokens.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.col("exact").alias("round_trip"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scanned(table(spark, sf_dir, "documents"))
    digests = secret_scan.span_digests(found.withColumn("hardest", F.array_max(F.transform("found", lambda x: x["log10_guesses"]))), "doc_id", ("assign", "access", "hex"), "hardest")
    return digests.withColumnRenamed("hardest", "max_log10_guesses")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digests(pii.spans_found(table(spark, sf_dir, "documents")), "doc_id", pii.BASE)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op8_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return bitsliced_topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"))


ORACLES["op8_bitsliced_topk"] = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
      WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mixing.mixed(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "row.source", "epoch", "n_tokens", "weight", "order_key")


ORACLES["op9_source_mixing"] = r"""
    WITH t AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens, coalesce(source, chr(0) || 'null') AS s, md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS own FROM documents),
    k AS (SELECT *, substr(md5('mix-1|' || s || '|' || substr(own, 1, 2)), 1, 8) || own AS key FROM t),
    g AS (SELECT s, sum(n_tokens) AS tokens FROM k GROUP BY s),
    p AS (SELECT s, CAST(tokens AS BIGINT) AS tokens, tokens / (SELECT CAST(sum(tokens) AS DOUBLE) FROM g) AS share FROM g WHERE tokens > 0),
    a AS (SELECT CASE WHEN max(share) = min(share) THEN 0 ELSE greatest(0, ceil((1 - ln(1.5) / ln(max(share) / min(share))) * 16777216)) / 16777216 END AS power FROM p),
    r AS (SELECT p.*, pow(share, power) AS raised FROM p, a),
    z AS (SELECT sum(raised) AS z, min(raised / share) AS least FROM r),
    w AS (SELECT s, tokens, round(raised / z.z, 9) AS weight, round(raised / share / z.least, 9) AS times FROM r, z),
    c AS (SELECT k.*, coalesce(w.weight, 0) AS weight, coalesce(floor(w.times), 1) AS epochs, floor((w.times - floor(w.times)) * w.tokens) AS rest, sum(n_tokens) OVER (PARTITION BY k.s ORDER BY key RANGE UNBOUNDED PRECEDING) AS total FROM k LEFT JOIN w ON k.s = w.s),
    e AS (SELECT *, unnest(range(CAST(epochs + CASE WHEN rest > 0 AND total <= rest THEN 1 ELSE 0 END AS BIGINT))) AS epoch FROM c)
    SELECT doc_id, source, CAST(epoch AS INTEGER) AS epoch, n_tokens, weight,
      substr(md5('mix-1|' || epoch || '|' || s || '|' || substr(md5('mix-1|' || epoch || '|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 2)), 1, 8) || md5('mix-1|' || epoch || '|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS order_key
    FROM e
"""


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.scored(docs, quality_classifier.fitted(docs, table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_html_extract": op2_html_extract,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_secret_scan": op5_secret_scan,
    "op6_pii": op6_pii,
    "op7_quality_rules": op7_quality_rules,
    "op8_bitsliced_topk": op8_bitsliced_topk,
    "op9_source_mixing": op9_source_mixing,
    "op10_quality_classifier": op10_quality_classifier,
}
