"""Quality rules and the quality classifier."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlens.llm import quality_classifier, quality_rules, queries, words
from sessionlens.llm.shared import table

from . import plain

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"


def made(seed, n=300):
    rng = random.Random(seed)
    parts = ["word", "é", "a", "b", "##", "<x>", "SHOUT!", "line one\n", "line one\n", "\n", " \n", "\t", "the cat sat on the mat", "😀", "|"]
    return [None, "", " \n ", *(" ".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(n))]


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_equal_plain(seed):
    texts = made(seed)
    counts = quality_rules.text_counts(texts)
    failed = quality_rules.base_failed(counts)
    for text, row, bad in zip(texts, counts.tolist(), failed.tolist(), strict=True):
        assert (*row[:5], bad) == plain.quality_base(text), text


def test_posterior_is_bayes():
    rng = np.random.default_rng(0)
    patterns = rng.integers(0, 3 ** len(quality_rules.RULES), 50)
    model = quality_rules.fit_label_model(patterns, rng.integers(1, 100, 50))
    for p in patterns[:10]:
        votes = quality_rules.votes_of(np.array([p]))[0]
        good, bad = model.prior, 1 - model.prior
        for k, v in enumerate(votes):
            good, bad = good * model.votes[1, k, v + 1], bad * model.votes[0, k, v + 1]
        assert abs(model.patterns[int(p)] - good / (good + bad)) < 1e-9
    assert np.allclose(model.votes.sum(axis=2), 1)


def test_em_finds_accuracies():
    """Votes drawn from a known model: the estimate separates the classes."""
    rng = np.random.default_rng(4)
    k = len(quality_rules.RULES)
    truth = rng.random(20_000) < 0.8
    votes = np.where(truth[:, None], rng.choice([1, 0, -1], (20_000, k), p=[0.8, 0.195, 0.005]), rng.choice([1, 0, -1], (20_000, k), p=[0.2, 0.3, 0.5]))
    patterns, often = np.unique(quality_rules.pattern_of(votes), return_counts=True)
    model = quality_rules.fit_label_model(patterns, often)
    assert abs(model.prior - 0.8) < 0.03
    assert np.mean((model.posterior(votes) >= 0.5) == truth) > 0.98


def test_rules_query(spark):
    given = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    rows = queries.op7_quality_rules(spark, SF).collect()
    assert len(rows) == len(given)
    for r in rows:
        assert (*(r[c] for c in quality_rules.COUNTS), r["base_failed"]) == (lambda x: (x[0], x[1], x[2], x[3], x[4], x[5]))(plain.quality_base(given[r["doc_id"]]))
        assert r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    clean = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1]
    assert np.mean(clean) > 0.9


def test_verdict_equals_plain(spark):
    given = {r["doc_id"]: r["text"] for r in table(spark, SF_LARGER, "documents").collect()}
    rows = [r for r in queries.op7_quality_rules(spark, SF_LARGER).collect() if not r["base_failed"]]
    votes = [tuple(v) for v in quality_rules.rule_votes(quality_rules.text_counts([given[r["doc_id"]] for r in rows])).tolist()]
    for r, p in zip(rows, plain.label_model(votes), strict=True):
        assert abs(r["posterior"] - p) < 1e-6 and r["kept"] == (p >= 0.5)
    assert any(min(v) < 0 and r["kept"] for v, r in zip(votes, rows, strict=True))  # not the rule that all must pass
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_LARGER, "labels").collect()}
    kept = {y: np.mean([r["kept"] for r in rows if labels.get(r["doc_id"]) == y]) for y in (0, 1)}
    assert kept[1] > 0.97 and kept[0] < 0.1


def test_rules_with_clashing_columns(spark):
    text = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (None, None)], "doc_id long, text string")
    for c in ("pattern", "posterior", "kept", "base_failed", "n_words"):
        df = df.withColumn(c, F.lit("x"))
    assert sorted((str(r["doc_id"]), r["kept"]) for r in quality_rules.judged(df).collect()) == [("1", True), ("None", False)]


def test_rules_defined_cases(spark):
    good = " ".join(f"word{i}" for i in range(60))
    docs = [(1, None), (2, ""), (3, good), (3, good), (None, good)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("pattern", F.lit("x")).withColumn("posterior", F.lit(None)).withColumn("kept", F.lit(False))
    out = quality_rules.judged(df.select("doc_id", "text")).collect()
    assert sorted((str(r["doc_id"]), r["kept"]) for r in out) == [("1", False), ("2", False), ("3", True), ("3", True), ("None", True)]
    kept = quality_rules.filtered(df)
    assert kept.columns == df.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "3", "None"]
    assert quality_rules.judged(df.limit(0)).collect() == [] and quality_rules.filtered(df.limit(0)).collect() == []


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    ones = label == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_classifier_on_held_out_rows(spark):
    rows = {r["doc_id"]: r for r in queries.op10_quality_classifier(spark, SF_LARGER).collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_LARGER, "labels").collect() if r["quality"] is not None}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    held = [d for d in labels if rows[d]["held_out"]]
    score, label = np.array([rows[d]["score"] for d in held]), np.array([labels[d] for d in held])
    assert auc(score, label) > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows.values())


def test_held_out_labels_are_not_read(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_classifier.fitted(docs, x) for x in (labels, turned))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_classifier_defined_cases(spark):
    docs = spark.createDataFrame([(1, "good text"), (2, None), (3, ""), (None, "x"), (1, "good text")], "doc_id long, text string").withColumn("label", F.lit(3)).withColumn("score", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality_classifier.scored(docs, quality_classifier.fitted(docs, none)).collect()
    assert len(rows) == 5 and all(r["score"] == 0.5 for r in rows)
    odd = spark.createDataFrame([(1, None), (2, 7), (None, 1), (3, 0), (4, 1), (6, 0), (1, 1)], "doc_id long, quality int")
    rows = quality_classifier.scored(docs, quality_classifier.fitted(docs, odd)).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert quality_classifier.scored(docs.limit(0), quality_classifier.fitted(docs.limit(0), none)).collect() == []


def test_gradient_training_learns():
    rng = random.Random(2)
    texts = [" ".join(rng.choices(("fine", "prose", "here"), k=20)) if i % 2 else " ".join(rng.choices(("spam", "buy", "now"), k=20)) for i in range(200)]
    labels = np.arange(200) % 2
    config = quality_classifier.ClassifierConfig(buckets=1 << 12)
    model = quality_classifier.train([quality_classifier.bag(t) for t in quality_classifier.tokens(texts, config)], labels, config)
    assert np.array_equal(quality_classifier.scores(texts, model, config) > 0.5, labels == 1)


@pytest.mark.parametrize("seed", [5, 6])
def test_scores_equal_plain(seed):
    """The sum over words, pairs and character n-grams, token by token."""
    config = quality_classifier.ClassifierConfig(buckets=1 << 10)
    rng = np.random.default_rng(seed)
    model = quality_classifier.Model(rng.normal(size=config.buckets * (2 + len(config.grams))).astype(np.float32), 0.25)
    mask = (1 << 64) - 1

    def mixed(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    def word(w):
        total = sum(int(words._CODE[b]) * pow(words._BYTE_BASE, k, 1 << 64) for k, b in enumerate(w.encode()))
        return mixed((total + len(w.encode())) & mask)

    texts = made(seed, 40)
    for text, score in zip(texts, quality_classifier.scores(texts, model, config), strict=True):
        hashes = [word(w) for w in plain.words(text)]
        numbers = [h % config.buckets for h in hashes]
        numbers += [config.buckets + (0 if a == b else mixed((3 * a + b) & mask) % config.buckets) for a, b in zip(hashes, hashes[1:], strict=False)]
        for k, n in enumerate(config.grams):
            for i in range(len(text or "") - n + 1):
                code = 0
                for c in text[i : i + n]:
                    code = (code * 0x10FFFF + ord(c)) & mask
                numbers.append(config.buckets * (2 + k) + mixed(code) % config.buckets)
        z = (sum(float(model.weights[x]) for x in numbers) / len(numbers) if numbers else 0.0) + model.bias
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-6, text


def test_no_text_is_left_out_of_fitting_by_its_length(spark):
    long, short = "rare " * 60_000, "plain words here"
    docs = spark.createDataFrame([(i, long if i % 2 else short) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    model = quality_classifier.fitted(docs, labels, config=quality_classifier.ClassifierConfig(max_train=30))
    low, high = quality_classifier.scores([short, long], model)
    assert low < 0.5 < high
