"""Exact top-k by inner product with a bit-sliced index.

Components are quantised to integers floor(scale * x). For a block of vectors the index holds,
for each dimension, the bits of all its values as bitmaps (slices). For one query the slices
are added with bitmap arithmetic: the value of a dimension times the query's component is a
sum of shifted slices, so the score of every row of the block arises in one pile of bitmaps a
weight, reduced by carry-save adders. The top rows are then picked from the most significant
slice of the sum downward. Lower slices of the components can be left out of the index
(``kept_bits``): scores are then known up to a bound, and all rows that could still be among the
top k, the boundary rows, are resolved exactly by their integer inner products.

Work is dealt out as cells of a block of queries and a block of vectors; a cell returns the
top k of each query, and one small window picks the best of all cells. A vector is sent once
for each block of queries.

Defined results: vectors that are null or empty, or hold null or non-finite components, take no
part, neither as queries nor as candidates; vectors of unequal length are compared only with
their own length; ties go to the smaller id; a query never meets rows of its own id; repeated
rows are candidates one by one, and of queries that share an id the one with the least vector
counts; an empty table gives an empty result. Scores are exact while they fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_W = np.uint64


@dataclass(frozen=True)
class TopkConfig:
    k: int = 5
    scale: int = 256
    kept_bits: int = 7  # slices a dimension in the index
    block_rows: int = 16_384
    block_queries: int = 16_384


class SlicedIndex:
    """Slices of the columns of an integer matrix (rows x dimensions)."""

    def __init__(self, values: np.ndarray, kept_bits: int):
        self.values = values
        self.low = values.min(axis=0) if len(values) else np.zeros(values.shape[1], np.int64)
        shifted = values - self.low  # not negative
        bits = int(shifted.max(initial=0)).bit_length()
        self.cut = max(0, bits - kept_bits)  # lower slices left out
        self.n, self.words = len(values), (len(values) + 63) // 64
        kept = (shifted >> self.cut).astype(np.uint64)
        self.slices: list[list[np.ndarray]] = []
        for d in range(values.shape[1]):
            self.slices.append([self._pack((kept[:, d] >> _W(b)) & _W(1)) for b in range(bits - self.cut)])
        self.rest = (shifted & ((1 << self.cut) - 1)).max(axis=0) if self.cut and len(values) else np.zeros(values.shape[1], np.int64)

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        out = np.zeros(self.words * 8, np.uint8)
        packed = np.packbits(bits.astype(np.uint8), bitorder="little")
        out[: len(packed)] = packed
        return out.view(np.uint64)

    def sum_slices(self, query: np.ndarray) -> tuple[list[np.ndarray | None], int, int, int]:
        """Slices of a sum S, with offset, unit and slack: offset + unit * S <= score <= offset + unit * S + slack.

        A negative component is added as its value times the complement of the slices, so
        that all terms are positive; the offset makes up for it.
        """
        piles: dict[int, list[np.ndarray]] = {}
        offset = int(query @ self.low)
        slack = 0
        for d, q in enumerate(query.tolist()):
            if not q:
                continue
            slack += abs(q) * int(self.rest[d])
            weight = abs(q)
            if q < 0:
                # q * x = |q| * (top - x) - |q| * top for the kept part; the rest of x only lowers it
                offset -= weight * (((1 << len(self.slices[d])) - 1) << self.cut)
                offset -= weight * int(self.rest[d])
            for shift in range(weight.bit_length()):
                if weight >> shift & 1:
                    for b, s in enumerate(self.slices[d]):
                        piles.setdefault(b + shift, []).append(~s if q < 0 else s)
        out: list[np.ndarray | None] = []
        place = 0
        while any(p >= place for p in piles):
            pile = piles.pop(place, [])
            carry = piles.setdefault(place + 1, []) if len(pile) > 1 else []
            while len(pile) > 2:  # carry-save adder: three bitmaps to a sum and a carry
                a, b, c = pile.pop(), pile.pop(), pile.pop()
                ab = a ^ b
                carry.append((a & b) | (ab & c))
                pile.insert(0, ab ^ c)
            if len(pile) == 2:
                a, b = pile
                carry.append(a & b)
                pile = [a ^ b]
            out.append(pile[0] if pile else None)
            place += 1
        return out, offset, 1 << self.cut, slack

    def top_rows(self, query: np.ndarray, k: int, without: np.ndarray) -> np.ndarray:
        """Rows that hold the k best ones: a superset, boundary rows included. ``without`` is a bitmap."""
        slices, _, unit, slack = self.sum_slices(query)
        alive = ~without
        if self.n % 64:
            alive[-1] &= _W((1 << self.n % 64) - 1)
        if self.n - int(np.bitwise_count(without).sum()) <= k:
            return self._rows(alive)
        need, threshold, tied = k, 0, alive
        for b in range(len(slices) - 1, -1, -1):  # the k-th largest sum, from the top slice downward
            if slices[b] is None:
                continue
            ones = tied & slices[b]
            count = int(np.bitwise_count(ones).sum())
            if count >= need:
                tied, threshold = ones, threshold | 1 << b
            else:
                need -= count
                tied = tied & ~slices[b]
        floor = threshold - (slack + unit - 1) // unit  # rows below it cannot reach the k-th row
        if floor <= 0:
            return self._rows(alive)
        above, equal = np.zeros_like(alive), alive
        for b in range(max(len(slices), floor.bit_length()) - 1, -1, -1):  # rows with a sum >= floor
            s = slices[b] if b < len(slices) else None
            if floor >> b & 1:
                equal = equal & s if s is not None else np.zeros_like(alive)
            elif s is not None:
                above = above | (equal & s)
                equal = equal & ~s
        return self._rows(above | equal)

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), count=self.n, bitorder="little"))


def cell_top(ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, config: TopkConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query id, vector id and score of the top k of each query in one block of vectors."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    index = SlicedIndex(values, config.kept_bits)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q, query in zip(query_ids.tolist(), queries, strict=True):
        own = np.zeros(index.words, np.uint64)
        for row in range(np.searchsorted(ids, q), np.searchsorted(ids, q, "right")):
            own[row // 64] |= _W(1 << row % 64)
        rows = index.top_rows(query, config.k, own)
        scores = values[rows] @ query  # boundary rows, exactly
        best = np.lexsort((rows, -scores))[: config.k]  # ids ascend with rows
        out.append((np.full(len(best), q), ids[rows[best]], scores[best]))
    return tuple(np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out, strict=True) if out else ([], [], [])))


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", config: TopkConfig = TopkConfig()) -> DataFrame:
    """query_id, rank, id and score of the k best candidates of each query."""
    whole = lambda v: F.transform(v, lambda x: F.floor(x.cast("double") * config.scale))
    usable = lambda v: F.coalesce(F.size(v) > 0, F.lit(False)) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    clean = lambda df: df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(F.col("id").isNotNull() & F.coalesce(usable(F.col("v")), F.lit(False))).select("id", whole(F.col("v")).alias("v"), F.size("v").alias("dim"))
    rows, asked = clean(vectors), clean(queries)
    n_rows, n_asked = vectors.count(), queries.count()
    row_blocks, query_blocks = -(-n_rows // config.block_rows) or 1, -(-n_asked // config.block_queries) or 1
    deal = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    cell = ["row_block", "query_block", "dim"]
    left = rows.withColumn("row_block", deal(row_blocks, 1)).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = asked.withColumn("query_block", deal(query_blocks, 2)).withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        stacked = lambda x: np.stack(x["v"].to_numpy()).astype(np.int64)
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "id": [], "score": []}, dtype=np.int64)
        once = b.assign(v=b["v"].map(tuple)).sort_values(["id", "v"]).drop_duplicates("id")
        q, i, s = cell_top(a["id"].to_numpy(np.int64), stacked(a), once["id"].to_numpy(np.int64), stacked(once), config)
        return pd.DataFrame({"query_id": q, "id": i, "score": s})

    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(run, "query_id long, id long, score long")
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")))
    return best.filter(F.col("rank") <= config.k).select("query_id", "rank", F.col("id").alias(id_col), "score")
