"""Readers: nested documents, frames, person lists, vectors, audio, folders, HTML tables."""

from __future__ import annotations

import csv
import io
import json
import wave
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import DOCUMENT, FRAMES, PEOPLE_HEADER, TURNS


class InvalidInput(ValueError):
    """An input file that breaks its format."""


def candidates(spark: SparkSession, folder: str, files: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """WAV files of a folder by name: path, length, modificationTime. ``files`` picks some by name."""
    rows = spark.read.format("binaryFile").load(folder).select("path", "length", "modificationTime").filter(F.lower("path").endswith(".wav"))
    if files is not None:
        rows = rows.filter(F.element_at(F.split("path", "/"), -1).isin(*files))
    rows = rows.orderBy("path")
    return rows if limit is None else rows.limit(limit)


def file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """path, sha256 and its first eight digits, of each file of a folder."""
    rows = spark.read.format("binaryFile").load(folder).select("path", F.sha2("content", 256).alias("sha256"))
    return rows.withColumn("sha8", F.left("sha256", F.lit(8)))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Nested session documents, by their declared schema."""
    return spark.read.schema(DOCUMENT).option("multiLine", True).json(path).withColumn("path", F.input_file_name())


def section(docs: DataFrame, field: str) -> DataFrame:
    """Rows of one array of the documents, the time struct flattened: section(d, "vad.segments")."""
    rows = docs.select(F.col("source.source_id").alias("source_id"), F.posexplode(field).alias("ord", "x")).select("source_id", "ord", "x.*")
    if "time" in rows.columns:
        rows = rows.select("*", F.col("time.start_seconds").alias("time_start"), F.col("time.end_seconds").alias("time_end")).drop("time").withColumnsRenamed({"time_start": "start_seconds", "time_end": "end_seconds"})
    return rows


def turn_documents(spark: SparkSession, path: str) -> DataFrame:
    """Turns joined with their analysis by position; different ids at a position are an error."""
    rows = spark.read.schema(TURNS).option("multiLine", True).json(path).withColumn("path", F.input_file_name())
    each = rows.select("path", F.posexplode(F.arrays_zip("turns", "turns_analysis")).alias("ord", "x")).select("path", "ord", F.col("x.turns").alias("turn"), F.col("x.turns_analysis").alias("analysis"))
    same = F.col("analysis").isNull() | F.col("turn.turn_id").eqNullSafe(F.col("analysis.turn_id"))
    return each.withColumn("turn", F.when(same, F.col("turn")).otherwise(F.raise_error(F.lit("turns and their analysis are not aligned"))))


def frames(spark: SparkSession, path: str) -> DataFrame:
    """Audio frames, features as floats."""
    rows = spark.read.schema(FRAMES).option("multiLine", True).json(path).select(F.explode("frames").alias("f")).select("f.*")
    return rows.select(*[F.col(c) if c in ("frame_index", "frame_center_seconds") else F.col(c).cast("float").alias(c) for c in rows.columns])


def people(spark: SparkSession, path: str, order: int = 0) -> DataFrame:
    """A person list with its exact header. Lines of another width are an error that names them.

    Lists are small and read whole by one task, as lines can only be counted in order.
    """
    raw = spark.read.format("binaryFile").load(path).select("content")
    header = list(PEOPLE_HEADER)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = list(csv.reader(io.StringIO(bytes(content).decode("utf-8-sig"))))
                if not rows or rows[0] != header:
                    raise InvalidInput("unexpected header")
                if len(rows) < 2:
                    raise InvalidInput("no rows")
                bad = [str(i) for i, r in enumerate(rows[1:], 2) if len(r) != len(header)]
                if bad:
                    raise InvalidInput(f"malformed rows: {', '.join(bad)}")
                yield pd.DataFrame(rows[1:], columns=header).assign(src_order=range(order * 1_000_000, order * 1_000_000 + len(rows) - 1))

    return raw.mapInPandas(run, ", ".join(f"`{h}` string" for h in header) + ", src_order long")


def known_people(spark: SparkSession, deputies: str | None = None, ministers: str | None = None) -> DataFrame:
    """The lists of deputies and of ministers after each other: id, name, role, kind, src_order.

    All on the first list are deputies; on the second, the prefix of the identifier says the kind.
    A deputy's role is that of the deputy, another's is the profession, null if it is empty.
    """
    from ..operators.identity import DEPUTY_ROLE, person_kind

    out = None
    for k, path in enumerate((deputies, ministers)):
        if path is None:
            continue
        rows = people(spark, path, k)
        ident = F.trim("identifiant")
        kind = F.lit("deputy") if k == 0 else person_kind(ident)
        work = F.trim("Profession")
        role = F.when(kind == "deputy", F.lit(DEPUTY_ROLE)).when(work != "", work)
        rows = rows.select(ident.alias("id"), F.trim(F.concat_ws(" ", "Prénom", "Nom")).alias("name"), role.alias("role"), kind.alias("kind"), "src_order")
        out = rows if out is None else out.unionByName(rows)
    return out


def archives(spark: SparkSession, path: str, vector: str = "embeddings") -> DataFrame:
    """NPZ archives of equally long arrays: a row a position, the matrix as array<float>.

    Types and lengths are checked; a wrong one is an error.
    """
    raw = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with np.load(io.BytesIO(bytes(content)), allow_pickle=False) as data:
                    if vector not in data or data[vector].ndim != 2 or data[vector].dtype != np.float32:
                        raise InvalidInput(f"{name}: {vector} must be a float32 matrix")
                    n = len(data[vector])
                    ids = {k: data[k] for k in data.files if k != vector}
                    for k, v in ids.items():
                        if v.ndim != 1 or len(v) != n:
                            raise InvalidInput(f"{name}: {k} must have {n} values")
                    yield pd.DataFrame({"path": name, "ord": np.arange(n), "ids": [json.dumps({k: int(v[i]) for k, v in ids.items()}) for i in range(n)], "vector": list(data[vector])})

    return raw.mapInPandas(run, "path string, ord long, ids string, vector array<float>")


def metadata(path: str) -> dict:
    """A small JSON object that stands beside vectors."""
    value = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(value, dict):
        raise InvalidInput(f"{path}: metadata must be one JSON object")
    return value


def _samples(w: wave.Wave_read, first: int, last: int) -> np.ndarray:
    """Mono float samples first .. last - 1 of a recording, zeros outside it."""
    total, channels, width = w.getnframes(), w.getnchannels(), w.getsampwidth()
    lo, hi = min(max(first, 0), total), min(max(last, 0), total)
    w.setpos(lo)
    x = np.frombuffer(w.readframes(hi - lo), {1: np.uint8, 2: np.int16, 4: np.int32}[width]).reshape(-1, channels).astype(np.float32)
    x = ((x - 128) / 128 if width == 1 else x / 2 ** (8 * width - 1)).mean(axis=1)
    out = np.zeros(last - first, np.float32)
    out[lo - first : lo - first + len(x)] = x
    return out


def resampled(read: Callable[[int, int], np.ndarray], rate: int, target: int, first: int, last: int, half: int = 32) -> np.ndarray:
    """Samples first .. last - 1 at the target rate: band-limited interpolation with a Hann window of ``half`` zero crossings a side.

    ``read`` gives samples of a range at the old rate. Pieces of a recording join without seams, as each reads
    what it needs beyond its ends.
    """
    if rate == target:
        return read(first, last)
    cut = min(1.0, target / rate)
    reach = int(np.ceil(half / cut))
    out = np.empty(last - first, np.float32)
    for a in range(first, last, 8192):
        b = min(a + 8192, last)
        at = np.arange(a, b) * (rate / target)
        low = int(at[0]) - reach
        x = read(low, int(at[-1]) + reach + 2)
        near = at.astype(np.int64)[:, None] + np.arange(1 - reach, reach + 1)
        apart = (near - at[:, None]) * cut
        kernel = cut * np.sinc(apart) * np.where(np.abs(apart) < half, 0.5 + 0.5 * np.cos(np.pi * apart / half), 0)
        out[a - first : b - first] = (x[near - low] * kernel).sum(axis=1)
    return out


def waves(spark: SparkSession, folder: str, seconds: float = 30.0, rate: int | None = None) -> DataFrame:
    """PCM WAV files as mono float samples in pieces: path, rate, first_sample, samples. ``rate`` resamples them."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.[wW][aA][vV]").load(folder).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with wave.open(io.BytesIO(bytes(content))) as w:
                    if w.getsampwidth() not in (1, 2, 4):
                        raise InvalidInput(f"{name}: {w.getsampwidth()} bytes a sample")
                    own = w.getframerate()
                    target = rate or own
                    count = -(-w.getnframes() * target // own)
                    size = int(target * seconds)
                    for at in range(0, count, size):
                        x = resampled(lambda a, b, w=w: _samples(w, a, b), own, target, at, min(at + size, count))
                        yield pd.DataFrame({"path": [name], "rate": [target], "first_sample": [at], "samples": [x]})

    return raw.mapInPandas(run, "path string, rate int, first_sample long, samples array<float>")


class _Rows(HTMLParser):
    def __init__(self):
        super().__init__()
        self.rows: list[list[tuple[str, str]]] = []
        self.cell: list[str] | None = None
        self.sort = ""

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag == "td" and self.rows:
            self.cell, self.sort = [], dict(attrs).get("data-sort") or ""

    def handle_endtag(self, tag):
        if tag == "td" and self.cell is not None:
            self.rows[-1].append((" ".join("".join(self.cell).split()), self.sort))
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def html_rows(pages: DataFrame, html: str = "html", ident: str = "page_id") -> DataFrame:
    """Table rows of pages with three cells or more: id, row, cells, and the parts of the first sort key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, page in zip(batch[ident], batch[html], strict=True):
                parser = _Rows()
                parser.feed(page or "")
                rows = [r for r in parser.rows if len(r) >= 3]
                out += [(key, k, [t for t, _ in r], next((s for _, s in r if s), "").split("_")) for k, r in enumerate(rows)]
            yield pd.DataFrame(out, columns=[ident, "row", "cells", "sort_parts"])

    return pages.select(ident, html).mapInPandas(run, f"{ident} {pages.schema[ident].dataType.simpleString()}, row int, cells array<string>, sort_parts array<string>")
