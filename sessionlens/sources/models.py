"""Hooks for models: any function of a batch, run where the data is. No model is shipped.

A loader is called once a Python worker, so that a model is loaded once and not for each row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.legacy import crop

Encoder = Callable[[list[str]], np.ndarray]
Recognizer = Callable[[str], list[dict]]


def encoded(df: DataFrame, text: str, load: Callable[[], Encoder], normalize: bool = True, name: str = "embedding") -> DataFrame:
    """Add vectors of a text column. ``load`` returns a function from texts to a matrix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            if not len(batch):
                continue
            m = np.asarray(model(batch[text].fillna("").tolist()), np.float32)
            if m.ndim != 2 or len(m) != len(batch):
                raise ValueError("the encoder must return one vector a text")
            if normalize:
                m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
            yield batch.assign(**{name: list(m)})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{fields}, {name} array<float>")


def entities(df: DataFrame, text: str, keys: list[str], load: Callable[[], Recognizer]) -> DataFrame:
    """One row a named entity: keys, ord, entity_group, score, word, start, end (code points)."""
    columns = [*keys, "ord", "entity_group", "score", "word", "start", "end"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            out = []
            for x in batch.to_dict("records"):
                out += [(*(x[k] for k in keys), i, e["entity_group"], float(e["score"]), e["word"], int(e["start"]), int(e["end"])) for i, e in enumerate(model(x[text] or ""))]
            yield pd.DataFrame(out, columns=columns)

    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, text).mapInPandas(run, f"{fields}, ord int, entity_group string, score double, word string, start int, end int")


def intervals(files: DataFrame, load: Callable[[], Callable[[bytes], list[tuple[float, float, str | None]]]]) -> DataFrame:
    """Voice or speaker intervals of audio files: path, segment_id from 1, start, end, speaker_id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            out = [(p, i, float(a), float(b), s) for p, c in zip(batch["path"], batch["content"], strict=True) for i, (a, b, s) in enumerate(model(bytes(c)), 1)]
            yield pd.DataFrame(out, columns=["path", "segment_id", "start_seconds", "end_seconds", "speaker_id"])

    return files.select("path", "content").mapInPandas(run, "path string, segment_id int, start_seconds double, end_seconds double, speaker_id string")


def voice_prints(files: DataFrame, segments: DataFrame, load: Callable[[], Callable[[bytes, float, float], np.ndarray]], skip_below: float = 0.08, least: float = 0.8) -> DataFrame:
    """Vectors of the voice in each segment: session_id, segment_id, speaker_id, embedding.

    Segments shorter than ``skip_below`` seconds have none. Others grow to ``least`` seconds inside the
    recording. files: session_id, content, duration_seconds. The model takes a recording and a time
    range; what it returns must be one vector. A recording is decoded where its segments are.
    """
    length = F.col("end_seconds") - F.col("start_seconds")
    asked = segments.filter(length >= skip_below).join(files.select("session_id", "duration_seconds"), "session_id")
    cut = crop(F.col("start_seconds"), F.col("end_seconds"), F.col("duration_seconds"), least)
    asked = asked.select("session_id", "segment_id", "speaker_id", cut.alias("c")).select("session_id", "segment_id", "speaker_id", F.col("c.start_seconds").alias("a"), F.col("c.end_seconds").alias("b"))
    kinds = asked.schema

    def run(audio: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(audio) and len(parts):
            model, content = load(), bytes(audio["content"].iloc[0])
            for x in parts.sort_values("segment_id").itertuples():
                v = np.asarray(model(content, x.a, x.b)).squeeze().astype(np.float32)
                if v.ndim != 1:
                    raise ValueError(f"segment {x.segment_id}: the model returned {v.shape} instead of one vector")
                out.append((x.session_id, x.segment_id, x.speaker_id, v))
        return pd.DataFrame(out, columns=["session_id", "segment_id", "speaker_id", "embedding"])

    fields = ", ".join(f"{c} {kinds[c].dataType.simpleString()}" for c in ("session_id", "segment_id", "speaker_id"))
    return files.select("session_id", "content").groupBy("session_id").cogroup(asked.groupBy("session_id")).applyInPandas(run, f"{fields}, embedding array<float>")
