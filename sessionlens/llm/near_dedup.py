"""Near-duplicate documents by HyperMinHash sketches, confirmed on full shingle sets.

1. A text's distinct shingle hashes are dealt to 128 buckets; each keeps its least hash,
   compressed to the number of leading zeros and ten mantissa bits (a HyperMinHash register). An empty
   bucket borrows from the first filled one of a fixed random order, so that small sets
   have full sketches too.
2. Texts with equal sets are one node, named by the smallest id. Four registers make a band
   of 32; nodes that agree in a band meet. At a similarity of 0.8 a pair misses all bands with
   a chance of 5e-8.
3. Nodes of a band's group form a star around the smallest one, whatever the number of bands
   in which they meet it. Stars are cut into blocks. In a block every node is compared with
   the centre on full sets, and each node that isn't linked to the centre with all others, if the
   collision-corrected estimate of their registers allows 0.8 at all. Nodes that are left
   unlinked in a star of several blocks are then compared with its other blocks. So each pair
   that agrees in a band is decided, and neither pairs nor hot groups are gathered anywhere.
4. Components of the links are found by alternating large and small stars in Spark. What is
   known of a node or centre is written before it is joined to the rows of it, so that both
   sides of those joins are plain shuffles and Spark splits the partition of a hot one.

Defined results: texts without words have an empty set and are linked with nothing; texts with
fewer words than a shingle have their whole sequence as the only one; repeated rows and rows
of equal id share a component through their sets; null ids take no part (null component, not
kept); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .words import slabs, whole, windows

REGISTERS, BANDS, BUCKET_BITS, MANTISSA = 128, 32, 7, 10
_U = np.uint64
_BORROW = np.stack([np.random.Generator(np.random.PCG64(i + 1)).permutation(REGISTERS) for i in range(REGISTERS)])


@dataclass(frozen=True)
class NearConfig:
    words: int = 5  # of a shingle
    percent: int = 80  # least similarity
    least_estimate: float = 0.5  # pairs estimated below are not compared (8 standard deviations)
    small: int = 64  # sets below are always compared
    block_rows: int = 256
    block_shingles: int = 1_000_000


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingle hashes of a word sequence, sorted."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    return np.unique(windows(hashes, min(size, len(hashes))))


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash sketch of a set, as 16 bit registers."""
    if not len(shingles):
        return np.zeros(REGISTERS, np.uint16)
    bucket = (shingles >> _U(64 - BUCKET_BITS)).astype(np.int64)  # sorted, as the set is
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    rest = (shingles[first] << _U(BUCKET_BITS)) | _U(1 << BUCKET_BITS - 1)  # the least of each bucket comes first
    high = rest >> _U(11)  # 53 bits, exact as a double
    zeros = 53 - np.frexp(high.astype(np.float64))[1]
    zeros = np.where(high == 0, 57, zeros).astype(np.uint64)
    mantissa = (rest << (zeros + _U(1))) >> _U(64 - MANTISSA)
    out = np.zeros(REGISTERS, np.uint16)
    filled = np.zeros(REGISTERS, bool)
    out[bucket[first]] = (zeros << _U(MANTISSA) | mantissa).astype(np.uint16)
    filled[bucket[first]] = True
    if len(first) < REGISTERS:
        empty = np.flatnonzero(~filled)
        order = _BORROW[empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out


def estimate(regs: np.ndarray, others: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    """Jaccard similarity of one set with others from their registers, corrected for chance agreement.

    Minima of different sets fall into one register value with a chance of about
    0.1699 * phi / 2^mantissa, phi = 4 (n / m) / (1 + n / m)^2.
    """
    agree = (others == regs).mean(axis=1)
    ratio = n / np.maximum(sizes, 1)
    chance = 0.169919487159739 * 4 * ratio / (1 + ratio) ** 2 / 2**MANTISSA
    return np.clip((agree - chance) / (1 - chance), 0, 1)


def sketches(docs: DataFrame, id_col: str, text_col: str, config: NearConfig) -> DataFrame:
    """Per row: id, n (set size), two hashes of the set, and its registers as 32 longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch.column(1), lower=True):
                n = len(slab)
                sets = [shingle_set(slab.hashes[slab.bounds[i] : slab.bounds[i + 1]], config.words) for i in range(n)]
                regs = np.concatenate([registers(s).view(np.int64) for s in sets])
                columns = [batch.column(0).slice(slab.first, n), pa.array([len(s) for s in sets], pa.int64()), *(pa.array([whole(s, k) for s in sets], pa.int64()) for k in (1, 2))]
                columns.append(pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * BANDS, pa.array(regs)))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "h1", "h2", "regs"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, n long, h1 long, h2 long, regs array<long>")


class Block:
    """Nodes of one block with their full sets."""

    def __init__(self, rows: dict, config: NearConfig):
        self.config = config
        sets: list[np.ndarray] = []
        for slab in slabs(rows["text"], lower=True):
            sets += [shingle_set(slab.hashes[slab.bounds[i] : slab.bounds[i + 1]], config.words) for i in range(len(slab))]
        own = [k for k, s in enumerate(sets) if whole(s, 1) == rows["h1"][k]]  # an id may stand for several texts
        self.rows, self.sets = own, [sets[k] for k in own]
        self.ids = np.array([rows["id"][k] for k in own], np.int64)
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.regs = np.array([rows["regs"][k] for k in own], np.int64).view(np.uint16).reshape(len(own), REGISTERS)

    def linked(self, shingles: np.ndarray, regs: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Those of the nodes ``among`` whose set is similar enough to a set."""
        n, sizes = len(shingles), self.sizes[among]
        fits = 100 * np.minimum(n, sizes) >= self.config.percent * np.maximum(n, sizes)
        among, sizes = among[fits], sizes[fits]
        near = (np.minimum(n, sizes) < self.config.small) | (estimate(regs, self.regs[among], n, sizes) >= self.config.least_estimate)
        among, sizes = among[near], sizes[near]
        if not len(among):
            return among
        flat = np.concatenate([self.sets[i] for i in among])
        at = np.minimum(np.searchsorted(shingles, flat), n - 1)
        common = np.add.reduceat((shingles[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
        return among[100 * common >= self.config.percent * (n + sizes - common)]


def star_links(block: Block, center: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links (row, row) of a block that holds the star's centre, and which rows aren't linked to it."""
    n = len(block.ids)
    root = np.arange(n)
    links = []
    middle = int(np.flatnonzero(block.ids == center)[0])
    everyone = np.arange(n)
    first = block.linked(block.sets[middle], block.regs[middle], everyone[everyone != middle])
    root[first] = middle
    links += [(int(i), middle) for i in first]
    outside = np.setdiff1d(everyone, np.append(first, middle))
    for o in outside:
        others = everyone[(root != root[o]) & (everyone != middle)]
        for i in block.linked(block.sets[o], block.regs[o], others):
            if root[i] != root[o]:
                links.append((int(o), int(i)))
                root[root == root[i]] = root[o]
    return links, outside


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[dict]:
    """Rows of equal leading columns, which stand together, as columns of lists."""
    rows: dict = {}
    last = None
    for batch in batches:
        names = batch.schema.names
        data = batch.to_pydict()
        marks = list(zip(*(data[k] for k in names[:keys]), strict=True))
        begin = 0
        for i in range(1, batch.num_rows + 1):
            if i < batch.num_rows and marks[i] == marks[begin]:
                continue
            if marks[begin] != last:
                if rows:
                    yield rows
                rows, last = {k: [] for k in names}, marks[begin]
            for k in names:
                rows[k] += data[k][begin:i]
            begin = i
    if rows:
        yield rows


def _within(config: NearConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, 2):
            block = Block(g, config)
            links, outside = star_links(block, g["center"][0])
            a, b = block.ids[[x for x, _ in links]], block.ids[[y for _, y in links]]
            # a link to the node itself says that it stays outside, where other blocks follow
            alone = block.ids[outside] if g["blocks"][0] > 1 else block.ids[:0]
            u, v = np.concatenate([np.maximum(a, b), alone]), np.concatenate([np.minimum(a, b), alone])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (np.full(len(u), g["center"][0]), u, v)], names=["center", "u", "v"])

    return run


def _across(config: NearConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, 3):
            block = Block(g, config)
            guest = np.array(g["guest"], bool)[block.rows]
            u, v = [], []
            members = np.flatnonzero(~guest)
            for o in np.flatnonzero(guest):
                found = block.linked(block.sets[o], block.regs[o], members)
                u += [block.ids[o]] * len(found)
                v += block.ids[found].tolist()
            pairs = np.array([u, v], np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs.max(axis=0)), pa.array(pairs.min(axis=0))], names=["u", "v"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) from edges u > v, by alternating large and small stars."""

    def least(both: DataFrame) -> DataFrame:
        return both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("m"))

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("s")).collect()[0]
        return r["n"], r["s"]

    e = stored(edges.select("u", "v").filter("u > v").distinct(), "edges")
    before = mark(e)
    while before[0]:
        both = e.selectExpr("u a", "v b").union(e.selectExpr("v a", "u b"))
        large = both.join(stored(least(both), "least"), "a").filter("b > a").select(F.col("b").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = stored(large, "edges")
        down = large.selectExpr("u a", "v b")
        small = down.join(stored(least(down), "least"), "a").select(F.inline(F.array(F.struct(F.col("b").alias("u"), F.col("m").alias("v")), F.struct(F.col("a").alias("u"), F.col("m").alias("v"))))).filter("u > v").distinct()
        e = stored(small, "edges")
        now = mark(e)
        if now == before:
            break
        before = now
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: NearConfig = NearConfig()) -> DataFrame:
    """Per row: id, n_shingles, component_id and kept (whether the row's id is its component's)."""
    sketch = stored(sketches(docs, id_col, text_col, config), "near-sketches")
    has = sketch.filter("n > 0 and id is not null")
    least = stored(has.groupBy("h1", "h2").agg(F.min("id").alias("node")), "near-sets")  # equal sets
    nodes = has.join(least.select(F.col("node").alias("id"), "h1", "h2"), ["id", "h1", "h2"], "left_semi")
    band = nodes.select("id", F.posexplode("regs").alias("band", "value")).select("id", F.xxhash64("band", "value").alias("key"))
    meet = band.groupBy("key").agg(F.min("id").alias("center"), F.max("id").alias("far")).filter("center < far").select("key", "center")
    star = stored(band.join(meet, "key").select("id", "center").distinct(), "near-stars")
    sized = nodes.select("id", "n", "h1", "regs").dropDuplicates(["id", "h1"])
    star = star.join(sized, "id")
    size = star.groupBy("center").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("rows") / config.block_rows), F.ceil(F.col("shingles") / config.block_shingles)).cast("int")
    wide = stored(size.select("center", blocks.alias("blocks")).filter("blocks > 1"), "near-wide")
    star = star.join(wide, "center", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    home = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # the centre stands in every block of its star
    where = F.when(F.col("id") == F.col("center"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(home))
    star = star.select("center", "id", "regs", "blocks", "h1", where.alias("where"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    cells = star.join(texts, "id").select("center", F.explode("where").alias("block"), "id", "h1", "text", "regs", "blocks")
    cells = stored(cells, "near-cells")
    dealt = cells.repartition("center", "block").sortWithinPartitions("center", "block", "id")
    links = stored(dealt.mapInArrow(_within(config), "center long, u long, v long"), "near-links")

    # stars of several blocks: nodes that stayed outside in theirs meet the other blocks
    alone = links.filter("u = v").select("center", F.col("u").alias("id"))
    spread = cells.filter("blocks > 1 and id <> center").withColumn("home", home)
    few = F.greatest(F.lit(1), F.ceil(F.col("blocks") / 4)).cast("int")  # groups of the guests
    lot = F.pmod(F.xxhash64("id", F.lit(7)), few).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k != F.col("home"))
    guests = spread.join(alone, ["center", "id"]).select("center", F.explode(others).alias("block"), lot.alias("lot"), "id", "h1", "text", "regs", F.lit(True).alias("guest"))
    hosts = spread.select("center", "block", F.explode(F.sequence(F.lit(0), few - 1)).alias("lot"), "id", "h1", "text", "regs", F.lit(False).alias("guest"))
    meeting = hosts.join(guests.select("center", "block", "lot").distinct(), ["center", "block", "lot"], "left_semi").unionByName(guests)
    crossed = meeting.repartition("center", "block", "lot").sortWithinPartitions("center", "block", "lot", "id").mapInArrow(_across(config), "u long, v long")
    edges = links.filter("u > v").select("u", "v").unionByName(crossed)

    found = components(edges)
    named = least.join(found.select(F.col("node"), "component"), "node", "left").select("h1", "h2", F.coalesce("component", "node").alias("component_id"))
    plain = sketch.filter("n = 0 or id is null").select("id", "n", F.when(F.col("n") == 0, F.col("id")).alias("component_id"))
    joined = has.join(named, ["h1", "h2"]).select("id", "n", "component_id").unionByName(plain)
    ident: Column = F.col("id").cast(docs.schema[id_col].dataType)
    return joined.select(ident.alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
