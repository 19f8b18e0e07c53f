"""Sentences to semantic chunks, centroids, and comparisons of vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import count_words, split_sentences
from ..functions.vectors import cosine, dot

DELTA, MIN_WORDS = -0.1, 8


def sentences(turns: DataFrame, text: str = "text", keys: tuple[str, ...] = ("session_id", "turn_id")) -> DataFrame:
    """One row a sentence of each turn, with its index from 0."""
    return turns.select(*keys, F.posexplode(split_sentences(F.col(text))).alias("sentence_index", "sentence"))


def adjacent(vectors: DataFrame, keys: tuple[str, ...], order: str, vector: str = "embedding", delta: float = DELTA) -> DataFrame:
    """Add ``cosine`` to the row before (vectors of length 1), its change ``delta``, and ``is_break`` where that is below ``delta``."""
    by = Window.partitionBy(*keys).orderBy(order)
    rows = vectors.withColumn("cosine", dot(F.col(vector), F.lag(vector).over(by)))
    rows = rows.withColumn("delta", F.col("cosine") - F.lag("cosine").over(by))
    return rows.withColumn("is_break", F.coalesce(F.col("delta") < delta, F.lit(False)))


def chunks(sentences_: DataFrame, vectors: DataFrame, keys: tuple[str, ...] = ("session_id", "turn_id"), min_words: int = MIN_WORDS, delta: float = DELTA, joiner: str = " ", closing: str = "") -> DataFrame:
    """Chunks of each turn: start (included) and end (excluded) of their sentences, and the text.

    Only sentences with ``min_words`` or more decide where a chunk begins; the others go
    with the chunk around them. ``vectors``: keys, sentence_index, embedding.
    """
    counted = sentences_.filter(count_words(F.col("sentence")) >= min_words).select(*keys, "sentence_index")
    marks = adjacent(vectors.join(counted, [*keys, "sentence_index"]), keys, "sentence_index", delta=delta).select(*keys, "sentence_index", "is_break")
    by = Window.partitionBy(*keys).orderBy("sentence_index").rowsBetween(Window.unboundedPreceding, 0)
    rows = sentences_.join(marks, [*keys, "sentence_index"], "left").withColumn("chunk_index", F.sum(F.coalesce(F.col("is_break").cast("int"), F.lit(0))).over(by))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sentence_index", "sentence"))), lambda x: x["sentence"]), joiner)
    found = rows.groupBy(*keys, "chunk_index").agg(F.min("sentence_index").alias("start_sentence_index"), (F.max("sentence_index") + 1).alias("end_sentence_index"), F.concat(text, F.lit(closing)).alias("text"))
    return found


def rebuilt_text(chunks_: DataFrame, turns: DataFrame, keys: tuple[str, ...] = ("session_id", "turn_id")) -> DataFrame:
    """Text of chunks from the sentences of their turns; an impossible range is an error."""
    rows = chunks_.join(turns.select(*keys, split_sentences(F.col("text")).alias("_s")), list(keys))
    ok = (F.col("start_sentence_index") >= 0) & (F.col("start_sentence_index") < F.col("end_sentence_index")) & (F.col("end_sentence_index") <= F.size("_s"))
    part = F.array_join(F.slice("_s", F.col("start_sentence_index") + 1, F.col("end_sentence_index") - F.col("start_sentence_index")), " ")
    return rows.withColumn("text", F.when(ok, part).otherwise(F.raise_error(F.lit("sentence range outside the turn")))).drop("_s")


def centroids(vectors: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Mean of the vectors of each key, position by position."""
    parts = vectors.select(key, F.posexplode(vector).alias("pos", "x")).groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return parts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("centroid"))


def to_centroid(vectors: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Add the cosine of each vector to its key's centroid."""
    return vectors.join(centroids(vectors, key, vector), key).withColumn("cosine", cosine(F.col(vector).cast("array<double>"), F.col("centroid")))


def centroid_pairs(vectors: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Cosines of the centroids of all pairs of keys, of which there are few (speakers of a session)."""
    some = centroids(vectors, key, vector)
    a, b = some.select(F.col(key).alias("a"), F.col("centroid").alias("va")), some.select(F.col(key).alias("b"), F.col("centroid").alias("vb"))
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", cosine(F.col("va"), F.col("vb")).alias("cosine"))


def masked_mean(vectors: DataFrame, key: str, vector: str = "embedding", weight: str = "mask") -> DataFrame:
    """Mean of token vectors under a mask."""
    return centroids(vectors.filter(F.col(weight) > 0), key, vector)
