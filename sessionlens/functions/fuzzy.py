"""Similarity of names from 0 to 100.

``ratio`` is the normalised Indel similarity: twice the longest common subsequence over both
lengths. ``wratio`` is the best of it, the token ratios (0.95) and, where lengths differ
much, the partial ratios (0.9 or 0.6), after the published definition of weighted ratios.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, 64 and more characters at a time in one integer."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & where.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


@lru_cache(1 << 16)
def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 * 2 * _lcs(a, b) / total if total else 100.0


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string with a part of the longer one, parts at the edges included."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    n = len(short)
    return max(ratio(short, long[max(0, i) : i + n]) for i in range(1 - n, len(long)))


def _combed(pairs: list[tuple[str, str]]) -> list[np.ndarray]:
    """For each pair: by place y of the long string a number t, so that the common subsequence of the short
    string and places lo to hi - 1 has as many characters as there are y in it with t < lo.

    Strands that cross a grid of both strings, combed cell by cell; cells on a diagonal, and all pairs, at
    once. Short strings are filled up in front and long ones behind with what matches nothing.
    """
    m, n = max(len(a) for a, _ in pairs), max(len(b) for _, b in pairs)
    small, large = np.full((m, len(pairs)), -1, np.int32), np.full((n, len(pairs)), -2, np.int32)
    for k, (a, b) in enumerate(pairs):
        small[: len(a), k] = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.int32)[::-1]
        large[: len(b), k] = np.frombuffer(b.encode("utf-32-le", "surrogatepass"), np.int32)
    codes = np.unique(np.concatenate((small.ravel(), large.ravel())), return_inverse=True)[1].astype(np.int16 if m + n < 1 << 15 else np.int32)
    small, large = codes[: small.size].reshape(small.shape), codes[small.size :].reshape(large.shape)
    h = np.repeat(np.arange(m, dtype=codes.dtype)[:, None], len(pairs), 1)
    v = np.repeat(np.arange(m, m + n, dtype=codes.dtype)[:, None], len(pairs), 1)
    for d in range(m + n - 1):
        lo, hi = max(0, m - 1 - d), min(m, n + m - 1 - d)
        at = slice(lo + d - m + 1, hi + d - m + 1)
        x, y = h[lo:hi], v[at]
        swap = (small[lo:hi] == large[at]) | (x > y)
        change = np.where(swap, x ^ y, 0)
        x ^= change
        y ^= change
    return [v[: len(b), k].astype(np.int64) - m for k, (_, b) in enumerate(pairs)]


def partial_ratios(pairs: list[tuple[str, str]], batch: int = 1 << 16) -> list[float]:
    """``partial_ratio`` of many pairs, each in as many steps as the product of both lengths."""
    out, waiting = [100.0 if not a and not b else 0.0 for a, b in pairs], []
    sides = [tuple(sorted(p, key=len)) for p in pairs]
    order = sorted((k for k, (a, _) in enumerate(sides) if a), key=lambda k: (len(sides[k][1]) // 128, len(sides[k][0])))
    for place, k in enumerate(order):
        waiting.append(k)
        if place + 1 == len(order) or (len(waiting) + 1) * len(sides[order[place + 1]][1]) > batch:
            for i, t in zip(waiting, _combed([sides[i] for i in waiting]), strict=True):
                n, size = len(sides[i][0]), len(t)
                y = np.arange(size)
                first = np.maximum(np.where(t < 0, 1 - n, t + 1), y - n + 1)  # windows from here to y count y
                some = first <= y
                steps = np.bincount(first[some] + n - 1, minlength=size + n) - np.bincount(y[some] + n, minlength=size + n)
                start = np.arange(1 - n, size)
                window = np.minimum(start + n, size) - np.maximum(start, 0)
                out[i] = float(np.max(200.0 * np.cumsum(steps)[: len(start)] / (n + window)))
            waiting = []
    return out


def _tokens(a: str, b: str) -> tuple[str, str, str]:
    x, y = set(a.split()), set(b.split())
    both = " ".join(sorted(x & y))
    return both, " ".join(sorted(x - y)), " ".join(sorted(y - x))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    both, left, right = _tokens(a, b)
    if both and (not left or not right):
        return 100.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    found = [ratio(one, two)]
    if both:
        found += [ratio(both, one), ratio(both, two)]
    return max(found)


def partial_token_ratio(a: str, b: str) -> float:
    both, left, right = _tokens(a, b)
    if both:
        return 100.0
    return max(partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial_ratio(left, right))


@lru_cache(1 << 16)
def wratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    spread = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if spread < 1.5:
        return max(best, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if spread <= 8 else 0.6
    return max(best, scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def wratios(pairs: list[tuple[str, str]]) -> list[float]:
    """``wratio`` of many pairs. Partial ratios that cannot win, by the subsequence of the whole strings, are left out."""
    best, parts = [0.0] * len(pairs), []
    for k, (a, b) in enumerate(pairs):
        if not a or not b:
            continue
        n, m = sorted((len(a), len(b)))
        best[k] = ratio.__wrapped__(a, b)
        if m / n < 1.5:
            best[k] = wratio.__wrapped__(a, b)
            continue
        scale = 0.9 if m / n <= 8 else 0.6
        both, left, right = _tokens(a, b)
        wanted = [(scale, a, b)]
        if both:
            best[k] = max(best[k], 0.95 * scale * 100.0)
        else:
            wanted += [(0.95 * scale, " ".join(sorted(a.split())), " ".join(sorted(b.split()))), (0.95 * scale, left, right)]
        for weight, x, y in wanted:
            common = _lcs(x, y)
            if not common or weight * (200.0 * common / (min(len(x), len(y)) + common)) > best[k]:
                parts.append((k, weight, x, y))
    for (k, weight, _, _), found in zip(parts, partial_ratios([(x, y) for _, _, x, y in parts]), strict=True):
        best[k] = max(best[k], weight * found)
    return best


def tokens_agree(a: str, b: str, least: float = 65.0) -> bool:
    """At least one token of the query ``a`` is also in ``b``, and each is or resembles one there."""
    x, y = a.split(), b.split()
    return bool(set(x) & set(y)) and all(t in y or max((ratio(t, u) for u in y), default=0.0) >= least for t in x)


def name_score(query: str | None, known: str | None, least_token: float = 65.0) -> float:
    """Score of a known name for a query; 0 if its tokens don't agree. One word counts only if it is the whole name."""
    if not query or not known:
        return 0.0
    if len(query.split()) < 2:
        return 100.0 if query == known else 0.0
    return wratio(query, known) if tokens_agree(query, known, least_token) else 0.0


class Names:
    """Known names, in order, to resolve queries against. All are normalised."""

    def __init__(self, names: list[str]):
        self.first: dict[str, int] = {}
        self.often = Counter(names)
        for k, name in enumerate(names):
            self.first.setdefault(name, k)
        self.letters = [(name, Counter(name), set(name.split())) for name in self.first]

    def _bounds(self, query: str) -> list[tuple[float, int]]:
        """What each score can be at most, from the letters in common (any, with a word in common); dearest first."""
        own, words = Counter(query), set(query.split())
        out = []
        for k, (name, letters, parts) in enumerate(self.letters):
            common = sum(min(n, letters[c]) for c, n in own.items())
            out.append((100.0 if words & parts else 200.0 * common / (common + min(len(query), len(name)) or 1), k))
        return sorted(out, key=lambda x: (-x[0], x[1]))

    def closest(self, query: str) -> tuple[int | None, float]:
        """Place and score of the best name by wratio, the first of equals. Names that cannot win are not compared."""
        best, found = -1.0, None
        for most, k in self._bounds(query):
            if most + 1e-6 < best:
                break
            score = wratio(query, self.letters[k][0])
            if score > best or score == best and k < found:
                best, found = score, k
        return (None, 0.0) if found is None else (self.first[self.letters[found][0]], best)

    def resolved(self, query: str | None, least: float, least_token: float = 65.0) -> tuple[int | None, float]:
        """Place of the name that a query means, or None, and its score.

        A query of one word means a name only if it is the whole of just one. Others mean the closest
        name, if it is close enough and its tokens agree; the score stays if they don't.
        """
        if not query or not self.first:
            return None, 0.0
        if " " not in query:
            return (self.first[query], 100.0) if self.often[query] == 1 else (None, 0.0)
        place, score = self.closest(query)
        if place is None:
            return None, 0.0
        name = next(n for n, k in self.first.items() if k == place)
        return (place if score >= least and tokens_agree(query, name, least_token) else None), score


@F.pandas_udf(DoubleType())
def weighted_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(wratios([(x or "", y or "") for x, y in zip(a, b, strict=True)]), dtype=float)
