"""Removal of passages that stand in several documents, by prefix-partitioned suffix trees.

A suffix is what follows a word of a document. A passage of ``size`` words that stands in two
documents is a path of the suffix tree to an internal node of that depth or more. A word is
removed if it lies in such a passage whose word sequence also starts in a document with a
smaller id.

1. Suffixes that cannot lie below a deep internal node are left out. Of every run of ``size``
   words the half-as-long run with the least hash is its anchor: equal passages have equal
   anchors, and neighbours mostly share theirs (about one anchor for 13 words). Only suffixes
   whose anchor stands in two documents are built. Texts whose word sequence is that of an
   earlier document are removed as a whole and take no part.
2. Variable-length prefixes split the suffixes into groups. Suffixes are counted by their first
   ``ladder[0]`` words; prefixes with more than ``group_suffixes`` are prolonged to the next
   length, and so on. Each group has at most that many suffixes, whatever the corpus.
3. A group is one subtree, held as the sorted array of its suffixes with the depths at which
   neighbours part. Its deep internal nodes are the runs of neighbours that agree in ``size``
   words. They give the repeats: every suffix below a node with an earlier document.
4. A deep node of more suffixes is a passage of very many documents. It is reduced to its
   smallest id before the shuffle, and its suffixes are dealt out in as many shares as groups of
   that size need, each with a row of that id as a guest, so that a passage of a third of all
   documents is in no single task.
5. The places of each document are united: neighbouring ones form one maximal repeat. The trees
   are cut at a depth of ``size`` words, as a deeper node can't remove a word that its suffixes'
   nodes at that depth leave.

Suffixes travel as hashes of their prefixes (32 bits, which only deal out groups) and of their
first ``size`` words (96 bits: among 10^13 suffixes, two different ones agree with a chance
below 0.001), never as texts. Tables of anchors and copies are written before they are joined,
so that Spark splits the partition of a hot one. Defined results: null and
empty texts have no words; documents shorter than ``size`` lose nothing; rows of equal id and text
get equal results, and rows of equal id and other text are judged against smaller ids only; null
ids count as the largest and are never a source of removal; an empty table gives an empty result;
columns besides id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .words import mix, slabs, whole, windows

_LAST = np.iinfo(np.int64).max
_OTHER = np.uint64(0x5851F42D4C957F2D)  # gives words a second hash


@dataclass(frozen=True)
class SubstringConfig:
    size: int = 50
    ladder: tuple[int, ...] = (6, 12, 25)  # words of a prefix
    group_suffixes: int = 4096


def anchors(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and hash of each passage's anchor: its run of size // 2 words with the least hash (the first of equals)."""
    half = max(1, size // 2)
    runs = windows(hashes, half)
    span = size - half + 1  # runs of one passage
    if len(runs) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best = np.arange(len(runs))
    width = 1
    while width * 2 <= span:  # positions of minima over doubling spans
        a, b = best[: len(best) - width], best[width:]
        best = np.where(runs[b] < runs[a], b, a)
        width *= 2
    a, b = best[: len(runs) - span + 1], best[span - width : span - width + len(runs) - span + 1]
    at = np.where(runs[b] < runs[a], b, a)
    return at, runs[at]


def covered(places: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of n words lie in the passages that begin at ``places``."""
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, places, 1)
    np.add.at(cover, places + size, -1)
    return np.cumsum(cover[:-1]) > 0


def runs_of(mask: np.ndarray) -> np.ndarray:
    """Begin and end of each run of true values, as rows."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge.reshape(-1, 2)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))


def _values(column: pa.ListArray, i: int) -> np.ndarray:
    """One list as an array; null is empty."""
    item = column[i].values
    return np.zeros(0, np.int64) if item is None else item.to_numpy(zero_copy_only=False)


def first_look(rows: DataFrame, config: SubstringConfig) -> DataFrame:
    """Per row: id, t, number of words, two hashes of the word sequence, and its distinct anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch.column(2)):
                n = len(slab)
                words = [slab.hashes[slab.bounds[i] : slab.bounds[i + 1]] for i in range(n)]
                sums = [pa.array([whole(h, k) for h in words], pa.int64()) for k in (1, 2)]
                marks = _lists([np.unique(anchors(h, config.size)[1]).view(np.int64) for h in words])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(slab.first, n), batch.column(1).slice(slab.first, n), pa.array(list(map(len, words)), pa.int64()), *sums, marks], names=["id", "t", "n", "h1", "h2", "anchors"])

    return rows.mapInArrow(run, "id long, t int, n long, h1 long, h2 long, anchors array<long>")


def suffixes_of(texts: DataFrame, config: SubstringConfig) -> DataFrame:
    """Suffixes whose anchor is shared: id, spot (t and place), hashes of their prefixes, and of their first ``size`` words."""
    names = [*(f"p{k}" for k in range(len(config.ladder))), "node", "check"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for slab in slabs(batch.column(2)):
                who, spots, keys = [], [], [[] for _ in names]
                for i in range(len(slab)):
                    h = slab.hashes[slab.bounds[i] : slab.bounds[i + 1]]
                    at = np.flatnonzero(np.isin(anchors(h, config.size)[1].view(np.int64), _values(batch.column(3), slab.first + i)))
                    for out, length in zip(keys, config.ladder, strict=False):
                        out.append((windows(h, length)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                    keys[-2].append(windows(h, config.size)[at].view(np.int64))
                    keys[-1].append((windows(mix(h ^ _OTHER), config.size)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                    spots.append(np.int64(marks[slab.first + i]) << np.int64(32) | at)
                    who.append(np.full(len(at), ids[slab.first + i], np.int64))
                if sum(map(len, who)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (who, spots, *keys)], names=["id", "spot", *names])

    return texts.select("id", "t", "text", "shared").mapInArrow(run, "id long, spot long, " + ", ".join(f"{x} int" for x in names[:-2]) + ", node long, check int")


def _subtrees(levels: int):
    """Sorted suffixes to those below a deep internal node with an earlier document.

    The columns are the prefix hashes, the two hashes of ``size`` words, id and spot, in this
    order of sorting. The depth at which two neighbours part is the number of leading columns
    that they have in common; below ``levels + 2`` they part before ``size`` words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first = None, 0  # keys of the last suffix, and the smallest id of its node
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(levels + 2)])
            ids = batch.column(levels + 2).to_numpy()
            same = np.logical_and.accumulate(keys[:, 1:] == keys[:, :-1], axis=0).sum(axis=0)  # depths at which neighbours part
            begins = np.concatenate([[last is None or bool((keys[:, 0] != last).any())], same < levels + 2])
            heads = np.flatnonzero(begins)
            least = np.concatenate([[first], ids[heads]])[np.cumsum(begins)]  # ids ascend below a node
            last, first = keys[:, -1].copy(), int(least[-1])
            late = np.flatnonzero(least < ids)
            yield pa.RecordBatch.from_arrays([batch.column(levels + 2).take(pa.array(late)), batch.column(levels + 3).take(pa.array(late))], names=["id", "spot"])

    return run


def repeats(suffixes: DataFrame, config: SubstringConfig) -> DataFrame:
    """id and spot of the suffixes that an earlier document repeats in ``size`` words; ``suffixes`` is a stored table."""
    prefixes = [f"p{k}" for k in range(len(config.ladder))]
    order = [*prefixes, "node", "check", "id"]
    rows, label, rest = suffixes, F.lit(None).cast("long"), F.lit(True)
    for name in (*prefixes, "node"):  # prolong the prefixes of too many suffixes; the others count as one null
        key = [name, "check"] if name == "node" else [name]
        counts = rows.groupBy(*[F.when(rest, F.col(x)).alias(x) for x in key]).agg(F.count("*").alias("n"), F.min("id").alias("first"), *[F.min(x).alias(f"_{x}") for x in prefixes])
        many = stored(counts.filter(F.col(name).isNotNull() & (F.col("n") > config.group_suffixes)), f"substring-{name}")
        shares = F.ceil(F.col("n") / config.group_suffixes).alias(f"shares_{name}")
        rows = rows.join(many.select(*key, shares), key, "left")  # at most a row for group_suffixes of the suffixes
        frequent = F.col(f"shares_{name}").isNotNull()
        label, rest = F.coalesce(label, F.when(rest & ~frequent, F.col(name).cast("long"))), rest & frequent
    # a deep node of too many suffixes: shares of it, each with the node's smallest id as a guest
    share = F.pmod(F.xxhash64("id", "spot"), F.coalesce("shares_node", F.lit(1).cast("long")))
    dealt = rows.select(F.coalesce(label, F.xxhash64("node", "check", share)).alias("label"), *order, "spot")
    guests = many.select("node", "check", "first", *[F.col(f"_{x}").alias(x) for x in prefixes], F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)).alias("share"))
    guests = guests.select(F.xxhash64("node", "check", "share").alias("label"), *prefixes, "node", "check", F.col("first").alias("id"), F.lit(-1).cast("long").alias("spot"))
    dealt = dealt.unionByName(guests)
    return dealt.repartition("label").sortWithinPartitions(*order).select(*order, "spot").mapInArrow(_subtrees(len(prefixes)), "id long, spot long")


def _kept(config: SubstringConfig):
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies = batch.column(3).to_numpy(zero_copy_only=False)
            for slab in slabs(batch.column(2), hashed=False):
                n, raw = len(slab), slab.data.tobytes()
                counts, spans, texts = [], [], []
                for i in range(n):
                    a, b = int(slab.bounds[i]), int(slab.bounds[i + 1])
                    places = _values(batch.column(4), slab.first + i)
                    mask = np.ones(b - a, bool) if copies[slab.first + i] else covered(places, b - a, config.size)
                    gone = runs_of(mask)
                    edges = np.concatenate([[0], gone.ravel(), [b - a]]).reshape(-1, 2)  # runs of kept words
                    counts.append(b - a)
                    spans.append([{"start": x, "end": y} for x, y in gone.tolist()])
                    kept = [raw[slab.starts[a + x] : slab.ends[a + y - 1]] for x, y in edges.tolist() if y > x]
                    texts.append(b" ".join(w for part in kept for w in part.split()).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(slab.first, n), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(texts, pa.string())], names=["id", "n_words", "removed", "kept"])

    return run


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: SubstringConfig = SubstringConfig()) -> DataFrame:
    """Per row: id, n_words, removed (maximal repeats: begin and end of each, in words) and kept (the other words, joined by a space)."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", F.hash("text").alias("t"), "text")  # an id may stand for several texts
    look = stored(first_look(rows, config), "substring-looks").filter(F.col("n") >= config.size)

    # Texts with the word sequence of a smaller id lose everything; the others are the tree's texts.
    least = stored(look.groupBy("h1", "h2").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").drop("most"), "substring-copies")
    known = stored(look.join(least, ["h1", "h2"], "left").select("id", "t", "anchors", F.coalesce(F.col("least") < F.col("id"), F.lit(False)).alias("copy")), "substring-texts")
    marks = known.filter("not copy").select("id", "t", F.explode("anchors").alias("anchor"))
    forked = stored(marks.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("anchor"), "substring-anchors")
    shared = stored(marks.join(forked, "anchor").groupBy("id", "t").agg(F.collect_set("anchor").alias("shared")), "substring-shared")
    suffixes = stored(suffixes_of(rows.join(shared, ["id", "t"]), config), "substring-suffixes")
    found = repeats(suffixes, config)
    place = F.col("spot").bitwiseAND(0xFFFFFFFF)
    places = stored(found.groupBy("id", F.shiftright("spot", 32).cast("int").alias("t")).agg(F.collect_set(place).alias("places")), "substring-places")

    copies = known.filter("copy").select("id", "t", F.lit(True).alias("copy")).distinct()
    told = rows.join(copies, ["id", "t"], "left").join(places, ["id", "t"], "left").select("id", "t", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "places")
    out = told.mapInArrow(_kept(config), "id long, n_words long, removed array<struct<start: long, end: long>>, kept string")
    ident = F.when(F.col("id") != _LAST, F.col("id")).cast(docs.schema[id_col].dataType)
    return out.select(ident.alias(id_col), "n_words", "removed", "kept")
