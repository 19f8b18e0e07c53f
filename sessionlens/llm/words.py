"""Words of many texts at once, as numpy arrays.

A word is a maximal run of characters other than space and U+0009 to U+000D. All of
those are single bytes in UTF-8, and no other character has such a byte, so words can be
found in the encoded text. Texts are taken in slabs of a megabyte (or one text, if it
is longer), which bounds the memory.

Hashes are 64 bit polynomials over random byte codes, finished by a mixing step. They
stand for words and word sequences; with 64 bits, two different sequences among 10^6
agree with a chance of about 3e-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLAB_BYTES = 1_000_000
_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20_240_607))
_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD1342543DE82EF95 | 1
IS_SEP = np.zeros(256, bool)
IS_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1 << 12, 1 << int(n - 1).bit_length() if n > 1 else 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(steps)
    return have[:n]


def inverse(base: int) -> int:
    """The inverse of an odd number modulo 2^64."""
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bit numbers that spreads every bit over all."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass
class Slab:
    """Words of texts ``first`` .. ``first + n - 1`` of a batch.

    starts, ends: byte range of each word in ``data``; hashes: of each word; bounds:
    words of text i are ``bounds[i]`` to ``bounds[i + 1]``; at: byte where text i begins.
    """

    first: int
    data: np.ndarray
    at: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


def slabs(texts: list[str | None] | pa.Array, lower: bool = False, hashed: bool = True) -> Iterator[Slab]:
    """Slabs of whole texts, in order. ``lower`` folds A-Z only; null counts as empty.

    The bytes of an Arrow column of strings are used where they lie.
    """
    part: list = []
    size = first = 0
    for i, raw in enumerate(_encoded(texts)):
        if part and size + len(raw) > SLAB_BYTES:
            yield _slab(part, first, lower, hashed)
            part, size, first = [], 0, i
        part.append(raw)
        size += len(raw) + 1
    if part:
        yield _slab(part, first, lower, hashed)


def _encoded(texts: list[str | None] | pa.Array) -> Iterator[bytes | memoryview]:
    if not isinstance(texts, pa.Array):
        yield from ((t or "").encode("utf-8", "surrogatepass") for t in texts)
        return
    if not len(texts):
        return
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, edges, data = texts.buffers()
    at = np.frombuffer(edges, wide)[texts.offset : texts.offset + len(texts) + 1].tolist()
    bytes_of = memoryview(data if data is not None else b"")
    there = texts.is_valid().to_pylist() if texts.null_count else [True] * len(texts)
    for a, b, has in zip(at, at[1:], there, strict=False):
        yield bytes_of[a:b] if has else b""


def _slab(part: list, first: int, lower: bool, hashed: bool) -> Slab:
    data = np.frombuffer(b"\n".join(part) + b"\n", np.uint8)
    if lower:
        data = _LOWER[data]
    at = np.zeros(len(part) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in part], out=at[1:])
    inside = ~IS_SEP[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]  # the last byte separates, so that each word ends
    hashes = np.zeros(len(starts), np.uint64)
    a = 0
    while hashed and a < len(starts):  # a megabyte of a very long text at a time
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + SLAB_BYTES, "right")))
        hashes[a:b] = _word_hashes(data[starts[a] : ends[b - 1]], starts[a:b] - starts[a], ends[a:b] - starts[a])
        a = b
    return Slab(first, data, at, starts, ends, hashes, np.searchsorted(starts, at))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * powers(_BYTE_BASE, n), out=sums[1:])
    back = powers(inverse(_BYTE_BASE), n)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; none if there are fewer words."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(_WORD_BASE, n), out=sums[1:])
    back = powers(inverse(_WORD_BASE), n)
    return mix((sums[size:] - sums[: n - size + 1]) * back[: n - size + 1] + _U(size))


def whole(hashes: np.ndarray, salt: int = 0) -> int:
    """Hash of a sequence (or sorted set) of hashes, as a signed 64 bit number."""
    h = mix(hashes + _U(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    total = (h * powers(_WORD_BASE, len(h))).sum(dtype=np.uint64) + _U(len(h))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])
