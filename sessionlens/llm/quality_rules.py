"""Quality rules combined by weak supervision.

Every rule looks at a few counts of a text and votes 1 (good), -1 (bad) or 0 (abstains).
Expectation-maximisation over the votes estimates, without any labels, how each rule votes
on good and on bad texts (a two-class naive Bayes model), and a text is kept if the
posterior probability of "good" is at least 0.5 and no base limit fails.

Spark reduces the corpus to the number of texts of each vote pattern. There are at most
3^rules patterns, so that table has a fixed bound, and the estimation over it on the
driver is exact: it uses every text of the corpus.

Defined results: a null or empty text has no words and fails the base limits; repeated
rows are judged one by one, alike; an empty table gives an empty result. Only the id and
text columns are read, so further columns can have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .words import IS_SEP, slabs, windows

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*b"#*$%&|<>"]] = True
_BLANK = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class QualityConfig:
    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    min_posterior: float = 0.5
    prior_good: float = 0.8
    iterations: int = 200
    pseudo_counts: float = 1.0
    max_false_alarm: float = 0.01


@dataclass
class LabelModel:
    """Vote probabilities: ``votes[y, rule, v + 1]`` for class y (0 bad, 1 good)."""

    prior: float
    votes: np.ndarray
    patterns: dict[int, float] = field(default_factory=dict)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of "good" for each row of votes."""
        logs = [np.log(p) + np.log(self.votes[y][np.arange(votes.shape[1]), votes + 1]).sum(axis=1) for y, p in ((0, 1 - self.prior), (1, self.prior))]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def text_counts(texts: list[str | None], config: QualityConfig = QualityConfig()) -> np.ndarray:
    """One row a text: COUNTS, upper-case letters A-Z, exclamation marks, distinct words, lines with a word, symbols at word ends."""
    out = np.zeros((len(texts), len(COUNTS) + 5), np.int64)
    for slab in slabs(texts):
        lead = np.zeros(len(slab.data) + 1, np.int64)  # of each prefix: code points in words
        np.cumsum(((slab.data & 0xC0) != 0x80) & ~IS_SEP[slab.data], out=lead[1:])
        symbols = np.zeros(len(slab.data) + 1, np.int64)
        np.cumsum(_SYMBOL[slab.data], out=symbols[1:])
        upper = np.zeros(len(slab.data) + 1, np.int64)
        np.cumsum((slab.data >= 65) & (slab.data <= 90), out=upper[1:])
        bangs = np.zeros(len(slab.data) + 1, np.int64)
        np.cumsum(slab.data == 33, out=bangs[1:])
        tails = np.zeros(len(slab.starts) + 1, np.int64)
        np.cumsum(_SYMBOL[slab.data[slab.ends - 1]], out=tails[1:])
        for i in range(len(slab)):
            a, b = slab.bounds[i], slab.bounds[i + 1]
            row = out[slab.first + i]
            at, to = slab.at[i], slab.at[i + 1]
            row[:3] = b - a, lead[to] - lead[at], symbols[to] - symbols[at]
            words = slab.hashes[a:b]
            found = windows(words, config.window)
            if len(found) > 1:
                _, back, often = np.unique(found, return_inverse=True, return_counts=True)
                if often.max() > 1:
                    cover = np.zeros(b - a + 1, np.int64)
                    again = np.flatnonzero(often[back] > 1)
                    np.add.at(cover, again, 1)
                    np.add.at(cover, again + config.window, -1)
                    row[4] = np.count_nonzero(np.cumsum(cover[:-1]))
            lines = [x for x in (texts[slab.first + i] or "").split("\n") if x.strip(_BLANK)]
            row[3] = len(lines) - len(set(lines))
            row[5:] = upper[to] - upper[at], bangs[to] - bangs[at], len(np.unique(words)), len(lines), tails[b] - tails[a]
    return out


def base_failed(counts: np.ndarray, config: QualityConfig = QualityConfig()) -> np.ndarray:
    words, repeat = counts[:, 0], counts[:, 4]
    return (words < config.min_words) | (100 * repeat > config.max_repeat_percent * words)


#: name: (share of what, good up to, bad from); between the two limits a rule abstains. Two shares that
#: rise together, as of symbols and of words that end in one, make one rule, as votes count as independent.
RULES = {
    "symbols": (lambda c, n: np.maximum(c[:, 2], 1.25 * c[:, 9]) / n, 0.02, 0.15),
    "repeated_windows": (lambda c, n: c[:, 4] / n, 0.05, 0.15),
    "capitals": (lambda c, n: c[:, 5] / np.maximum(c[:, 1], 1), 0.08, 0.25),
    "exclamations": (lambda c, n: c[:, 6] / n, 0.02, 0.2),
    "repeated_words": (lambda c, n: np.where(c[:, 0] >= 40, 1 - c[:, 7] / np.sqrt(n * 40), np.nan), 0.45, 0.7),
    "repeated_lines": (lambda c, n: np.where(c[:, 8] >= 3, c[:, 3] / np.maximum(c[:, 8], 1), np.nan), 0.1, 0.3),
    "word_length": (lambda c, n: np.abs(c[:, 1] / n - 5.5), 2.5, 6.0),
}


def rule_votes(counts: np.ndarray) -> np.ndarray:
    """Votes of each rule on each text: 1, 0 or -1. Texts without words get abstentions."""
    out = np.zeros((len(counts), len(RULES)), np.int64)
    words = np.maximum(counts[:, 0], 1)
    for k, (share, good, bad) in enumerate(RULES.values()):
        x = share(counts, words)
        out[:, k] = np.where(counts[:, 0] == 0, 0, np.where(x <= good, 1, np.where(x >= bad, -1, 0)))
    return out


def pattern_of(votes: np.ndarray) -> np.ndarray:
    """The votes of a text as one number below 3^rules."""
    return ((votes + 1) * 3 ** np.arange(votes.shape[1])).sum(axis=1)


def votes_of(patterns: np.ndarray, rules: int = len(RULES)) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(rules) % 3 - 1


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, config: QualityConfig = QualityConfig()) -> LabelModel:
    """Expectation-maximisation over vote patterns and how many texts have each.

    It begins with texts that a rule calls bad. A rule's rate of bad votes on good texts is held at
    ``max_false_alarm`` or less: without that, the likelier explanation of a corpus with
    several kinds of bad text would be that some kinds are good. The class called good is the one on which the rules
    vote good more often, so that the two classes cannot change places.
    """
    rules = len(RULES)
    votes = votes_of(patterns, rules)
    weight = counts.astype(float)
    good = np.array([0.95, 0.3, 0.05])[np.minimum((votes < 0).sum(axis=1), 2)]
    model = LabelModel(config.prior_good, np.full((2, rules, 3), 1 / 3))
    for _ in range(config.iterations if len(patterns) else 0):
        table = np.empty((2, rules, 3))
        for y, p in ((0, 1 - good), (1, good)):
            for v in range(3):
                table[y, :, v] = (weight * p) @ (votes == v - 1) + config.pseudo_counts
        table /= table.sum(axis=2, keepdims=True)
        alarm = np.minimum(table[1, :, 0], config.max_false_alarm)  # of a rule on good texts
        table[1, :, 1:] *= ((1 - alarm) / (1 - table[1, :, 0]))[:, None]
        table[1, :, 0] = alarm
        prior = float(np.clip((weight @ good + config.pseudo_counts) / (weight.sum() + 2 * config.pseudo_counts), 0.01, 0.99))
        model = LabelModel(prior, table)
        new = model.posterior(votes)
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    if len(patterns) and (model.votes[1, :, 2] - model.votes[0, :, 2]).sum() < 0:
        model = LabelModel(1 - model.prior, model.votes[::-1].copy())
    every = np.arange(3**rules)
    model.patterns = dict(zip(every.tolist(), model.posterior(votes_of(every, rules)).tolist(), strict=True))
    return model


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: QualityConfig = QualityConfig()) -> DataFrame:
    """Per text: id, COUNTS, base_failed and the vote pattern."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            counts = text_counts(batch.column(1).to_pylist(), config)
            columns = [batch.column(0), *(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(base_failed(counts, config)), pa.array(pattern_of(rule_votes(counts)))]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, *COUNTS, "base_failed", "pattern"])

    schema = f"`{id_col}` {id_type}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, pattern long"
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def fitted(counts: DataFrame, config: QualityConfig = QualityConfig()) -> LabelModel:
    """The label model of all texts that pass the base limits (the others are decided)."""
    rows = counts.filter("not base_failed").groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").toPandas()  # at most 3^rules rows
    return fit_label_model(rows["pattern"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), config)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: QualityConfig = QualityConfig()) -> DataFrame:
    """Per text: id, counts, base_failed, posterior and kept."""
    counts = stored(counted(docs, id_col, text_col, config), "quality-counts")
    model = fitted(counts, config)
    session = docs.sparkSession
    table = session.createDataFrame([*model.patterns.items()], "pattern long, posterior double")
    out = counts.join(F.broadcast(table), "pattern", "left")  # 3^rules rows, whatever the corpus
    return out.select(id_col, *COUNTS, "base_failed", "posterior", (~F.col("base_failed") & (F.col("posterior") >= config.min_posterior)).alias("kept"))


def filtered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: QualityConfig = QualityConfig()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns unchanged."""
    model = fitted(counted(docs, id_col, text_col, config), config)
    place, names = docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            counts = text_counts(batch.column(place).to_pylist(), config)
            votes = rule_votes(counts)
            keep = ~base_failed(counts, config) & (model.posterior(votes) >= config.min_posterior)
            yield pa.RecordBatch.from_arrays(batch.columns, names=names).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
