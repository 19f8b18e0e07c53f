"""Near-duplicate classes against all pairs compared plainly."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlens.llm import near_dedup, queries
from sessionlens.llm.shared import table
from sessionlens.llm.words import slabs

from . import plain

SF = "/root/testdata/sf0.001"


def made(seed, groups=25):
    """Groups of texts that differ in more and more words; some are very short."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = ["", None, "one", "One", "two words", "two  words", "a b c", "a b d"]
    for _ in range(groups):
        words = rng.choices(vocabulary, k=rng.choice((4, 12, 40, 150, 400)))
        for _ in range(rng.randint(1, 7)):
            texts.append(rng.choice((" ", "\n")).join(w.upper() if rng.random() < 0.05 else w for w in words))
            words = [w if rng.random() < rng.choice((0.9, 0.97, 1.0)) else rng.choice(vocabulary) for w in words]
    return texts


def found(spark, docs, **config):
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("regs", F.lit(1)).withColumn("n", F.lit(2))
    return near_dedup.classes(df, config=near_dedup.NearConfig(**config)).collect()


@pytest.mark.parametrize(("seed", "words", "block"), [(1, 2, 256), (2, 5, 256), (3, 2, 2)])
def test_equals_all_pairs(spark, seed, words, block):
    docs = list(enumerate(made(seed), start=3))
    random.Random(seed).shuffle(docs)
    rows = found(spark, docs, words=words, block_rows=block)
    assert {r["doc_id"]: r["component_id"] for r in rows} == plain.components(docs, words)
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {d: len(plain.shingles(t, words)) for d, t in docs}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows) and len(rows) == len(docs)


def test_large_group_in_blocks(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(100)]
    docs = []
    for i in range(150):  # chains of neighbours around one text
        own = words[:]
        own[rng.randrange(100)] = f"x{i}"
        docs.append((i, " ".join(own)))
    rows = found(spark, docs, words=2, block_rows=16)
    assert {r["doc_id"]: r["component_id"] for r in rows} == plain.components(docs, 2)


def test_defined_cases(spark):
    docs = [(None, "some text here"), (5, "some text here"), (5, "some text here"), (9, "some text here"), (7, None), (8, ""), (6, " \t\n")]
    rows = found(spark, docs, words=2)
    assert len(rows) == 7
    by = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in rows}
    assert by == {(None, 2): (None, False), (5, 2): (5, True), (9, 2): (5, False), (7, 0): (7, True), (8, 0): (8, True), (6, 0): (6, True)}
    assert found(spark, [], words=2) == []


def test_query_equals_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert {r["doc_id"]: r["component_id"] for r in queries.op1_near_dedup(spark, SF).collect()} == plain.components(docs, 2)


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(3)
    for shared, own in ((900, 50), (800, 200), (500, 500), (0, 1000)):
        errors = []
        for _ in range(40):
            x = rng.integers(0, 2**64, shared + 2 * own, dtype=np.uint64)
            a, b = np.unique(x[: shared + own]), np.unique(np.concatenate([x[:shared], x[shared + own :]]))
            got = near_dedup.estimate(near_dedup.registers(a), near_dedup.registers(b)[None, :], len(a), np.array([len(b)]))[0]
            errors.append(got - shared / (shared + 2 * own))
        assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.25


def test_registers_hold_leading_zeros_and_mantissa():
    x = np.array([(5 << 57) | (1 << 50)], np.uint64)  # bucket 5; the rest is 1 followed by 50 zeros, after six zeros
    reg = near_dedup.registers(x)[5]
    assert reg >> near_dedup.MANTISSA == 6 and reg & (1 << near_dedup.MANTISSA) - 1 == 0


def test_words_of_very_long_text():
    text = " ".join(f"v{i}" for i in range(600_000)) + " " + "x" * 2_000_000
    (slab,) = slabs([text])
    assert len(slab.hashes) == 600_001
    assert len(np.unique(slab.hashes)) == 600_001
    (short,) = slabs(["v0 v599999 " + "x" * 2_000_000])
    assert short.hashes.tolist() == slab.hashes[[0, 599_999, 600_000]].tolist()
