"""Plain, slow versions of the corpus operators, one text or one small table at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii_base(text: str | None) -> tuple[int, int, int, int, str]:
    text = text or ""
    found = []
    for no, (kind, pattern) in enumerate(
        {
            "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        }.items()
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), no, kind, m.end()))
    said = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))
    return (*(sum(x[1] == no for x in found) for no in range(4)), hashlib.sha256(said.encode()).hexdigest())


def quality_base(text: str | None) -> tuple[int, int, int, int, int, bool]:
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + j for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for j in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, dup, len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)


def label_model(votes: list[tuple[int, ...]], alarm: float = 0.01, pseudo: float = 1.0) -> list[float]:
    """Posterior of each row of votes by expectation-maximisation, row by row."""
    good = [{0: 0.95, 1: 0.3}.get(sum(v < 0 for v in row), 0.05) for row in votes]
    for _ in range(200):
        share = {}
        for k in range(len(votes[0])):
            for y in (0, 1):
                sums = {v: pseudo + sum(g if y else 1 - g for g, row in zip(good, votes, strict=True) if row[k] == v) for v in (-1, 0, 1)}
                whole = sum(sums.values())
                share[k, y] = {v: n / whole for v, n in sums.items()}
                if y and share[k, y][-1] > alarm:
                    rest = (1 - alarm) / (1 - share[k, y][-1])
                    share[k, y] = {-1: alarm, 0: share[k, y][0] * rest, 1: share[k, y][1] * rest}
        prior = min(max((sum(good) + pseudo) / (len(votes) + 2 * pseudo), 0.01), 0.99)
        new = []
        for row in votes:
            a, b = prior, 1 - prior
            for k, v in enumerate(row):
                a, b = a * share[k, 1][v], b * share[k, 0][v]
            new.append(a / (a + b))
        still = max(abs(x - y) for x, y in zip(new, good, strict=True)) < 1e-9
        good = new
        if still:
            break
    return good


def shingles(text: str | None, size: int = 2) -> frozenset:
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def components(docs: list[tuple[int, str | None]], size: int = 2) -> dict[int, int]:
    sets = {d: shingles(t, size) for d, t in docs}
    root = {d: d for d in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    by: dict = {}
    for d in sets:
        for s in sets[d]:
            by.setdefault(s, []).append(d)
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def substring_dedup(docs: list[tuple[int, str | None]], size: int = 50) -> dict[int, tuple[int, int, str]]:
    first: dict = {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        w = words(t)
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), d)
    out = {}
    for d, t in docs:
        w = words(t)
        gone = {i + j for i in range(len(w) - size + 1) if first[tuple(w[i : i + size])] < d for j in range(size)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out[d] = len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()
    return out
