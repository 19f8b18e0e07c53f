"""A corpus pipeline from the operators of the corpus subpackage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm import near_dedup, pii, quality_rules, sentencepiece_scan, source_mixing
from sessionlens.llm.shared import passing, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    return quality_rules.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (five-word shingles, similarity of 0.8).

    A row is judged by its node: its doc_id, or, where that is null or stands for a smaller
    text too, a number beyond all ids (62 bits of a hash of id and text). So rows without an
    id and different texts under one id are documents like others, and of exact repeats of
    id and text one row stays.
    """
    key = F.xxhash64("text")
    repeated = stored(docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.min(key).alias("low")).filter("n > 1").select("doc_id", "low"), "near-repeated-ids")
    low = docs.filter("doc_id is not null").join(repeated, "doc_id", "left")
    rows = low.unionByName(docs.filter("doc_id is null").withColumn("low", F.lit(None).cast("long")))
    fresh = F.xxhash64("doc_id", "text").bitwiseAND((1 << 62) - 1) + F.lit(1 << 62)
    own = F.col("doc_id").isNotNull() & (F.col("low").isNull() | (F.col("low") == key))
    rows = rows.withColumn("node", F.when(own, F.col("doc_id")).otherwise(fresh))
    kept = near_dedup.classes(rows.select("node", "text"), id_col="node").filter("kept").select("node")
    rows = rows.join(kept.distinct(), "node", "left_semi")
    once = rows.filter("low is null and doc_id is not null")
    several = rows.filter("low is not null or doc_id is null").dropDuplicates(["node"])
    return once.unionByName(several).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by their kind; n_chars is that of the new text."""
    return pii.masked(docs, chars_col="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents of small sources so that the sources meet their weights; every document stays."""
    return source_mixing.mixed(docs).select(*[f"row.`{c}`" for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    return sentencepiece_scan.encoded(docs).selectExpr("doc_id", "cast(size(token_ids) as bigint) n_tokens", "token_ids")


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mixing", mixing),
    ("tokens", tokens),
]

#: SQL cannot express the stages; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with passing(spark):  # what a stage keeps meanwhile goes when it is written
            docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
