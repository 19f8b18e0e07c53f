"""A quality classifier from supervised subword embeddings.

A text is a bag of hashed tokens: its words, its adjacent word pairs (a word that stands
twice in a row is one token of its own) and its character n-grams. Every token has a learned
vector; the vectors of a text are averaged and a softmax layer over two classes scores the
average. Vectors and layer are trained by stochastic gradient descent in numpy.

Only a bounded sample of labelled rows is used for fitting (``max_train`` rows in
expectation, chosen by a hash of the id, whatever their texts); scoring covers all texts
whole. Executors turn the chosen texts into bags, so that the driver gets at most one number
and one share a bucket of each, however long the text is. As the output is linear in the
average, the learned vectors are folded into one weight a token before scoring.

Inputs of a score are the text alone. A text without tokens (null or empty) gets the score
of the bias. Labels other than 0 and 1 and null labels are not used; with labels of one
class or none, every score is that class's share or 0.5. Repeated rows get equal scores.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Slab, mix, slabs

_U = np.uint64


@dataclass(frozen=True)
class ClassifierConfig:
    buckets: int = 1 << 16  # a kind of token
    dim: int = 8
    grams: tuple[int, ...] = (3, 5)
    epochs: int = 4
    rate: float = 0.6
    max_train: int = 4000  # labelled rows, in expectation
    threshold: float = 0.3
    seed: int = 7


@dataclass
class Model:
    weights: np.ndarray  # of each token: what it adds to the logit of class 1, times the count
    bias: float


def _characters(slab: Slab) -> tuple[np.ndarray, np.ndarray]:
    """The code points of a slab, and where each text begins in them (one separates two texts)."""
    lead = (slab.data & 0xC0) != 0x80
    before = np.zeros(len(slab.data) + 1, np.int64)
    np.cumsum(lead, out=before[1:])
    points = np.frombuffer(slab.data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    return points.astype(np.uint64), before[slab.at]


def tokens(texts: list[str | None] | pa.Array, config: ClassifierConfig) -> Iterator[np.ndarray]:
    """Token numbers of each text, in order."""
    size = _U(config.buckets)
    for slab in slabs(texts):
        pairs = mix(slab.hashes[:-1] * _U(3) + slab.hashes[1:]) % size if len(slab.hashes) > 1 else np.zeros(0, _U)
        if len(pairs):
            pairs[slab.hashes[:-1] == slab.hashes[1:]] = 0
        words = slab.hashes % size
        data, at_chars = _characters(slab)
        grams = []
        for k, n in enumerate(config.grams):
            code = np.zeros(max(len(data) - n + 1, 0), np.uint64)
            for j in range(n if len(code) else 0):
                code = code * _U(0x10FFFF) + data[j : len(data) - n + 1 + j]
            grams.append((mix(code) % size + _U(k + 2) * size).astype(np.int32))
        words, pairs = words.astype(np.int32), (pairs + size).astype(np.int32)
        for i in range(len(slab)):
            a, b = slab.bounds[i], slab.bounds[i + 1]
            at, to = at_chars[i], at_chars[i + 1] - 1
            yield np.concatenate([words[a:b], pairs[a : max(b - 1, a)], *(g[at : max(to - n + 1, at)] for g, n in zip(grams, config.grams, strict=True))])


def bag(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct tokens and their shares; None without tokens."""
    if not len(numbers):
        return None
    ids, often = np.unique(numbers, return_counts=True)
    return ids, (often / len(numbers)).astype(np.float32)


def train(bags: list[tuple[np.ndarray, np.ndarray] | None], labels: np.ndarray, config: ClassifierConfig = ClassifierConfig()) -> Model:
    """Fit by SGD, one bag at a time (None: a text without tokens), with a rate that falls to zero."""
    kinds = config.buckets * (2 + len(config.grams))
    rng = np.random.default_rng(config.seed)
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    bias = np.array([np.log(1 - share), np.log(share)]) if len(labels) else np.zeros(2)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(kinds, np.float32), float(bias[1] - bias[0]))
    vectors = rng.uniform(-0.5, 0.5, (kinds, config.dim)).astype(np.float32) / config.dim
    layer = rng.normal(0, 0.3, (2, config.dim)).astype(np.float32)
    steps, step = config.epochs * len(bags), 0
    for _ in range(config.epochs):
        for i in rng.permutation(len(bags)):
            rate = config.rate * (1 - step / steps)
            step += 1
            if bags[i] is None:
                continue
            ids, share_of = bags[i]
            mean = share_of @ vectors[ids]
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = p @ layer
            layer -= np.float32(rate) * np.outer(p, mean).astype(np.float32)
            bias -= 0.1 * rate * p
            vectors[ids] -= np.float32(rate) * 20 * share_of[:, None] * back.astype(np.float32)
    return Model(vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0]))


def scores(texts: list[str | None] | pa.Array, model: Model, config: ClassifierConfig = ClassifierConfig()) -> np.ndarray:
    z = np.array([model.weights[t].mean(dtype=np.float64) if len(t) else 0.0 for t in tokens(texts, config)]) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", config: ClassifierConfig = ClassifierConfig()) -> Model:
    """Train on a bounded sample of the labelled rows whose crc32(id) mod 5 is not 0."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    usable = labels.select(id_col, label_col).filter(F.col(label_col).isin(0, 1) & (crc % 5 != 0)).groupBy(id_col).agg(F.min(label_col).alias("label"))
    count = usable.count()
    chosen = usable.filter(F.xxhash64(id_col, F.lit(config.seed)).bitwiseAND((1 << 30) - 1) < int(min(1.0, config.max_train / max(count, 1)) * (1 << 30)))  # about max_train rows
    chosen = F.broadcast(chosen.withColumnRenamed(id_col, "id"))  # about max_train rows
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(chosen, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [bag(t) or (np.zeros(0, np.int32), np.zeros(0, np.float32)) for t in tokens(batch.column(1), config)]
            ends = np.concatenate([[0], np.cumsum([len(x) for x, _ in bags])]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([x[k] for x in bags]))) for k in (0, 1)] if bags else [pa.array([], pa.list_(pa.int32())), pa.array([], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).cast(pa.int64()), batch.column(3), *lists], names=["id", "label", "mark", "tokens", "shares"])

    id_type = docs.schema[id_col].dataType.simpleString()
    found = rows.select("id", "text", "label", F.xxhash64("text").alias("mark")).mapInArrow(run, f"id {id_type}, label long, mark long, tokens array<int>, shares array<float>")
    got = found.toArrow().sort_by([("id", "ascending"), ("mark", "ascending")])
    pairs = zip(got["tokens"], got["shares"], strict=True)
    bags = [(t.values.to_numpy(), s.values.to_numpy()) if len(t.values) else None for t, s in pairs]
    return train(bags, got["label"].to_numpy().astype(np.int64), config)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", config: ClassifierConfig = ClassifierConfig()) -> DataFrame:
    """Per row: id, held_out, score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 bytes a bucket, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            score = scores(batch.column(1), shared.value, config)
            apart = pa.array([held_out(x) for x in batch.column(0).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), apart, pa.array(score), pa.array((score >= config.threshold).astype(np.int32))], names=[id_col, "held_out", "score", "predicted"])

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, held_out boolean, score double, predicted int"
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)
