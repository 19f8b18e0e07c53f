"""The chunked scan against the library on whole texts, and exact round trips."""

import random

import pytest
from pyspark.sql import functions as F

from sessionlens.llm import queries
from sessionlens.llm import sentencepiece_scan as sp
from sessionlens.llm.shared import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sp.pieces().library


def made(seed, n):
    rng = random.Random(seed)
    parts = ["the", "ing", "tion", "a", "é", "中文", "😀", "  ", " ", "\n", "0", "12345", "xyz", "qqq", "Wort", ".", "...", "\t", "ab", "zz"]
    return "".join(rng.choice(parts) + (" " if rng.random() < 0.5 else "") for _ in range(n))


@pytest.mark.parametrize("seed", range(6))
def test_scan_equals_library(library, seed):
    text = made(seed, 400)
    assert sp.encode_long(text, 1) == library.encode(text)  # the smallest chunks that are possible


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 2000, " " * 1500, "\n" * 700, "é" * 900, "xyzzy" * 500, "中文" * 500, "1" * 999 + " " + "1" * 999, " lead", "trail "])
def test_scan_of_hard_texts(library, text):
    assert sp.encode_long(text, 1) == library.encode(text)


def test_states_combine_associatively():
    rng = random.Random(1)
    states = [(0, 1), (1, 3), (2, 4)]
    m = [[(a, b, rng.randint(1, 9)) for a in states for b in states if rng.random() < 0.7] for _ in range(3)]
    x, y, z = ([(a, b, w, ()) for a, b, w in k] for k in m)
    left, right = sp.combine(sp.combine(x, y), z), sp.combine(x, sp.combine(y, z))
    assert {(a, c): w for a, c, w, _ in left} == {(a, c): w for a, c, w, _ in right}


def test_frames(spark, library):
    docs = [(1, None), (2, ""), (3, "short text"), (3, "short text"), (4, made(7, 3000)), (5, made(7, 3000)), (None, made(8, 2500)), (6, "▁ odd")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("no", F.lit(2)).withColumn("id", F.lit("x"))
    rows = sp.encoded(df, chunk_chars=1000)
    got = sorted(((r["doc_id"], r["token_ids"], r["exact"]) for r in rows.collect()), key=str)
    wanted = sorted(((d, library.encode(t or ""), d != 6) for d, t in docs), key=str)
    assert got == wanted
    back = sorted(((r["doc_id"], r["text"]) for r in sp.decoded(rows).collect()), key=str)
    assert back == sorted(((d, "  odd" if d == 6 else t or "") for d, t in docs), key=str)
    assert sp.encoded(df.limit(0)).collect() == []


def test_query_round_trip(spark, library):
    rows = {r["doc_id"]: r for r in queries.op4_sentencepiece(spark, SF).collect()}
    for r in table(spark, SF, "documents").collect():
        assert rows[r["doc_id"]]["n_tokens"] == len(library.encode(r["text"] or "")) and rows[r["doc_id"]]["round_trip"]
