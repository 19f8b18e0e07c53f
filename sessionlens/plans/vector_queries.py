"""Queries over embeddings: search, centroids, breakpoints, chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.vectors import cosine, dot, has_bad_values, norm
from ..operators import chunking
from ..sources.adapters import table
from .registry import query


@query(
    "semantic_search_topk",
    """
    WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 0)
    SELECT e.vec_id, CAST(e.label AS BIGINT) AS turn_id, round(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(q.v AS DOUBLE[])), 6) AS score
    FROM embeddings e, q ORDER BY score DESC, vec_id LIMIT 5
    """,
)
def semantic_search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors nearest to vector 0; the one-row query side is broadcast."""
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.filter("vec_id = 0").select(F.col("embedding").alias("v")).limit(1)
    score = F.round(dot(F.col("embedding"), F.col("v")), 6)
    return vectors.crossJoin(F.broadcast(asked)).select("vec_id", F.col("label").cast("long").alias("turn_id"), score.alias("score")).orderBy(F.desc("score"), "vec_id").limit(5)


_CEN = """ps AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
    av AS (SELECT label, pos, avg(x) AS x FROM ps GROUP BY ALL), ce AS (SELECT label, list(x ORDER BY pos) AS c FROM av GROUP BY label)"""


@query("speaker_centroids", f"WITH {_CEN} SELECT label, CAST(pos AS INTEGER) AS pos, round(x, 6) AS x FROM av")
def speaker_centroids(spark: SparkSession, d: str) -> DataFrame:
    rows = chunking.centroids(table(spark, d, "embeddings"), "label")
    return rows.select("label", F.posexplode("centroid").alias("pos", "x")).select("label", (F.col("pos") + 1).alias("pos"), F.round("x", 6).alias("x"))


@query("cosine_to_centroid_bottomk", f"WITH {_CEN} SELECT vec_id, e.label, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c), 6) AS cosine FROM embeddings e JOIN ce USING (label) ORDER BY cosine, vec_id LIMIT 20")
def cosine_to_centroid_bottomk(spark: SparkSession, d: str) -> DataFrame:
    rows = chunking.to_centroid(table(spark, d, "embeddings"), "label")
    return rows.select("vec_id", "label", F.round("cosine", 6).alias("cosine")).orderBy("cosine", "vec_id").limit(20)


@query("all_pairs_centroid_cosine", f"WITH {_CEN} SELECT a.label AS a, b.label AS b, round(list_cosine_similarity(a.c, b.c), 6) AS cosine FROM ce a JOIN ce b ON a.label < b.label")
def all_pairs_centroid_cosine(spark: SparkSession, d: str) -> DataFrame:
    return chunking.centroid_pairs(table(spark, d, "embeddings"), "label").withColumn("cosine", F.round("cosine", 6))


_ADJ = """a0 AS (SELECT label, vec_id, list_dot_product(CAST(embedding AS DOUBLE[]), CAST(lag(embedding) OVER w AS DOUBLE[])) AS cosine FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
    a1 AS (SELECT *, cosine - lag(cosine) OVER (PARTITION BY label ORDER BY vec_id) AS delta FROM a0)"""


@query("adjacent_cosine_breakpoints", f"WITH {_ADJ} SELECT label, vec_id, round(cosine, 6) AS cosine, round(delta, 6) AS delta, coalesce(delta < -0.1, false) AS is_break FROM a1")
def adjacent_cosine_breakpoints(spark: SparkSession, d: str) -> DataFrame:
    rows = chunking.adjacent(table(spark, d, "embeddings"), ("label",), "vec_id")
    return rows.select("label", "vec_id", F.round("cosine", 6).alias("cosine"), F.round("delta", 6).alias("delta"), "is_break")


@query("semantic_chunks", f"WITH {_ADJ}, k AS (SELECT *, sum(CASE WHEN delta < -0.1 THEN 1 ELSE 0 END) OVER (PARTITION BY label ORDER BY vec_id ROWS UNBOUNDED PRECEDING) AS chunk FROM a1) SELECT label, CAST(chunk AS BIGINT) AS chunk_index, min(vec_id) AS first_id, max(vec_id) AS last_id, count(*) AS n FROM k GROUP BY ALL")
def semantic_chunks(spark: SparkSession, d: str) -> DataFrame:
    by = Window.partitionBy("label").orderBy("vec_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = chunking.adjacent(table(spark, d, "embeddings"), ("label",), "vec_id").withColumn("chunk_index", F.sum(F.col("is_break").cast("int")).over(by))
    return rows.groupBy("label", "chunk_index").agg(F.min("vec_id").alias("first_id"), F.max("vec_id").alias("last_id"), F.count("*").alias("n"))


@query("vector_norms_topk", "SELECT vec_id, round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm FROM embeddings ORDER BY norm DESC, vec_id LIMIT 10")
def vector_norms_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").filter(~has_bad_values(F.col("embedding")))
    return rows.select("vec_id", F.round(norm(F.col("embedding")), 6).alias("norm")).orderBy(F.desc("norm"), "vec_id").limit(10)


@query(
    "best_turn_by_chunk_scores",
    """WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 1), t AS (SELECT label, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(v AS DOUBLE[])) AS s FROM embeddings, q ORDER BY s DESC, vec_id LIMIT 20)
    SELECT label, round(sum(s), 5) AS score, count(*) AS chunks FROM t GROUP BY label""",
)
def best_turn_by_chunk_scores(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    asked = vectors.filter("vec_id = 1").select(F.col("embedding").alias("v")).limit(1)
    top = vectors.crossJoin(F.broadcast(asked)).select("label", "vec_id", cosine(F.col("embedding"), F.col("v")).alias("s")).orderBy(F.desc("s"), "vec_id").limit(20)
    return top.groupBy("label").agg(F.round(F.sum("s"), 5).alias("score"), F.count("*").alias("chunks"))
