"""Substring removal against a plain version."""

import random

import pytest
from pyspark.sql import functions as F

from sessionlens.llm import queries, substring_dedup
from sessionlens.llm.shared import table

from . import plain

SF = "/root/testdata/sf0.001"


def digest(df):
    rows = df.select("doc_id", "n_words", F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]).alias("n"), F.sha2("kept", 256).alias("sha")).collect()
    return sorted(((r["doc_id"], (r["n_words"], r["n"], r["sha"])) for r in rows), key=str)


def made(seed, docs=60, words=12):
    """Texts of passages in changing order, so that repeats overlap and nest."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.choice((5, 20, 49, 50, 51, 80)))) for _ in range(8)]
    texts = []
    for _ in range(docs):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(vocabulary, k=rng.randint(1, 40))) for _ in range(rng.randint(1, 6))]
        texts.append(rng.choice((" ", "\n", "\t ")).join(parts))
    return texts


@pytest.mark.parametrize("group", [1, 7, 4096])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain(spark, seed, group):
    docs = list(enumerate(made(seed)))
    random.Random(seed).shuffle(docs)
    config = substring_dedup.SubstringConfig(group_suffixes=group)
    found = digest(substring_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string"), config=config))
    assert found == sorted(plain.substring_dedup(docs).items(), key=str)
    assert sum(x[1][1] for x in found) > 500


def test_defined_cases(spark):
    long = " ".join(f"a{i}" for i in range(120))
    docs = [(3, None, 1), (4, "", 2), (5, long, 3), (5, long, 4), (6, long + " more", 5), (None, long, 6), (None, "x " + long, 7), (7, "  \n ", 8), (8, "y " + long, 9), (9, "one two", 10)]
    df = spark.createDataFrame(docs, "doc_id long, text string, t int").withColumn("anchors", F.lit("clash")).withColumn("kept", F.lit(1))
    rows = {(r["doc_id"], r["n_words"]): r for r in substring_dedup.deduplicated(df).collect()}
    assert rows[3, 0]["kept"] == "" and rows[4, 0]["removed"] == [] and rows[7, 0]["kept"] == ""
    assert rows[5, 120]["removed"] == []  # rows of one id do not remove each other
    assert [tuple(x) for x in rows[6, 121]["removed"]] == [(0, 120)] and rows[6, 121]["kept"] == "more"
    assert rows[8, 121]["kept"] == "y" and rows[9, 2]["kept"] == "one two"
    assert rows[None, 120]["kept"] == "" and rows[None, 121]["kept"] == "x"
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.deduplicated(empty).collect() == []


def test_query_equals_plain(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in queries.op3_substring_dedup(spark, SF).collect()}
    assert found == plain.substring_dedup(docs)


def test_very_long_text(spark):
    text = " ".join(f"v{i * i}" for i in range(400_000))
    docs = spark.createDataFrame([(1, text), (2, "start " + text)], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in substring_dedup.deduplicated(docs).collect()} == {1: text, 2: "start"}
