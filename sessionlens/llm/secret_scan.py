"""Secrets in texts: three fixed patterns, and values that would be hard to guess.

Base kinds: ``assign`` (a credential word, ``:`` or ``=``, a value of 6+ characters),
``access`` (AKIA keys of 20+ characters) and ``hex`` (24+ hexadecimal digits); each is
matched leftmost and without overlaps, and a match that fails its length is dropped.

The kind ``guess`` adds values that stand after further credential words ("pwd", "bearer",
"passphrase is" ...) and compounds with them or with "key" ("SECRET_KEY", "signing-key"). Such a value counts only if it would take many guesses: a dynamic
programme finds the cheapest way to split it into common words, dates, repeats, sequences,
keyboard walks and brute-force spans, where a part's cost is the log10 of its guesses. A
word's guesses are its rank: by the number of texts of the corpus that hold it (five at
least, the 100 000 most frequent words), or in a short list of what passwords are made of. Values
that one base span contains whole are not reported twice; those that reach beyond it are.

Positions are code points, ends exclusive. Defined results: null and empty texts have no
spans; repeated rows give repeated results; an empty table gives an empty result; columns
besides id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

KINDS = ("assign", "access", "hex", "guess")
_ANY = lambda s: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in s)
_NAMES = "|".join([*map(_ANY, ("password", "passwd", "secret", "token")), f"{_ANY('api')}_?{_ANY('key')}"])
ASSIGN = re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
_CONTEXT_WORDS = ("passphrase", "passcode", "pwd", "pass", "password", "passwd", "secret", "token", "credential", "credentials", "bearer", "private_key", "access_key", "auth_key", "api_key", "apikey", "client_key", "login_key")
_WORD = "|".join(_ANY(w) for w in sorted(_CONTEXT_WORDS, key=len, reverse=True))
#: Credential words, also as parts of compounds ("db_password", "secret_value"), and ``key`` as the last part of one ("signing-key", "signingKey").
CONTEXT = re.compile(rf"""(?:(?:(?<![A-Za-z0-9])(?:{_WORD})|(?:(?<=[A-Za-z0-9][_-]){_ANY("key")}|(?<=[a-z])Key)[sS]?)["']?(?:\x20*[:=]\x20*|\x20+(?:is|was)\x20+|\x20+(?=[A-Za-z0-9+/_.=-]*[0-9]))|(?<![A-Za-z0-9])(?:{_WORD})(?:[_-][A-Za-z0-9]++){{1,3}}["']?\x20*[:=]\x20*)["']?([^\s"'<>,;]+)""")
_HINTS = ("pass", "pwd", "secret", "token", "credential", "bearer", "key")


class Ranks(dict):
    """Words by rank; the rank is the number of guesses. Hashed by identity, for guess_cost."""

    __hash__ = object.__hash__
    __eq__ = object.__eq__

    def __init__(self, words: dict[str, int]):
        super().__init__(words)
        self.longest = max(map(len, self), default=0)


#: Words that passwords are made of; word_ranks adds those of the corpus.
WORDS = Ranks({w: i + 1 for i, w in enumerate("password the qwerty admin welcome letmein monkey dragon master login hello love secret test user root guest changeme shadow sun moon star summer winter spring autumn baseball football soccer hockey access flower princess angel tiger lion eagle happy money freedom whatever cookie orange purple yellow green blue red black white silver gold computer internet server database token key api example sample demo temp default system public private company office house home family friend mother father brother sister michael jennifer thomas daniel jessica robert william charlie batman superman pokemon starwars is my your our and for with from this that one two three four five six seven eight nine ten".split())})
_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "qwertzuiop", "azertyuiop", "abcdefghijklmnopqrstuvwxyz")
_STEPS = {p for r in _ROWS for x in (r, r[::-1]) for p in zip(x, x[1:], strict=False)}
_LEET = str.maketrans("01345@$!7", "oieasasit")
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d")
#: Words of the corpus; what stands next to digits is none.
_CORPUS_WORD = r"(?<![\p{L}\p{N}])\p{L}{3,24}+(?![\p{L}\p{N}])"


@dataclass(frozen=True)
class SecretConfig:
    min_assign: int = 6
    min_value: int = 6
    min_log10_guesses: float = 9.0
    part_cost: float = 0.7  # log10 of the guesses for how parts are combined
    min_docs: int = 5  # texts that a word of the corpus stands in
    max_words: int = 100_000  # most frequent words of the corpus; they are sent to every executor


#: Classes of characters and how many a class has; of a span with classes c, each character takes log10 of their sum.
_SIZES = (26, 26, 10, 33)
_EACH = [math.log10(max(sum(n for k, n in enumerate(_SIZES) if c >> k & 1), 10)) for c in range(16)]


def _class(c: str) -> int:
    """Number of a character's class: lower case, upper case, digit, other."""
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if not c.isalnum() else 0


def _brute(part: str) -> float:
    return len(part) * _EACH[sum(1 << k for k in set(map(_class, part)))]


class Runs:
    """From each position of a value: how far one character, a keyboard walk, or a block of 2 to 8 goes on. Linear in the length."""

    def __init__(self, value: str):
        low, n = value.lower(), len(value)
        low = low if len(low) == n else value
        self.low = low
        self.same, self.walk = [1] * n, [1] * n
        self.again = {size: [0] * (n + 1) for size in range(2, 9)}  # characters equal to those ``size`` further on
        for i in range(n - 2, -1, -1):
            if low[i] == low[i + 1]:
                self.same[i] = self.same[i + 1] + 1
            if (low[i], low[i + 1]) in _STEPS:
                self.walk[i] = self.walk[i + 1] + 1
            for size, often in self.again.items():
                if i + size < n and value[i] == value[i + size]:
                    often[i] = often[i + 1] + 1


def part_costs(value: str, i: int, config: SecretConfig, runs: Runs | None = None, words: Ranks = WORDS) -> Iterator[tuple[int, float, str]]:
    """The parts that begin at i, but for brute-force spans: end, log10 of guesses, kind.

    A repeat is one character three times or more, or a block of 2 to 8 twice or more.
    """
    runs = runs or Runs(value)
    low, n = runs.low, len(value)
    for j in range(i + 2, min(n, i + words.longest) + 1):
        plain = low[i:j]
        rank = words.get(plain) or 2 * words.get(plain.translate(_LEET), 0)
        if rank:
            upper = sum(c.isupper() for c in value[i:j])
            yield j, math.log10(rank + 1) + (math.log10(2) if upper in (0, 1, j - i) and upper else upper * 0.5), "word"
    if (m := _DATE.match(value, i)) and m.end() > i:
        yield m.end(), math.log10(366 * 120 if m.end() - i > 4 else 120), "date"
    if runs.same[i] >= 3:
        yield i + runs.same[i], math.log10(95 * runs.same[i]), "repeat"
    for size, often in runs.again.items():  # a block again and again
        if often[i] >= size:
            times = often[i] // size + 1
            yield i + size * times, _brute(value[i : i + size]) + math.log10(times), "repeat"
    if runs.walk[i] >= 3:
        yield i + runs.walk[i], math.log10(len(_ROWS) * 2 * 20 * runs.walk[i]), "walk"


@lru_cache(4096)
def guess_cost(value: str, config: SecretConfig = SecretConfig(), words: Ranks = WORDS) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` takes.

    Brute-force spans have any length. One that is open at a place is known by the classes that
    it may draw from, so that each place has at most 15 of them; a span is cheapest with just
    the classes that it holds.
    """
    best = [0.0] + [math.inf] * len(value)
    runs = Runs(value)
    kinds = sorted(set(map(_class, value)))
    sets = [c for c in range(1, 16) if all(k in kinds for k in range(4) if c >> k & 1)]
    spans = dict.fromkeys(sets, math.inf)
    for i, char in enumerate(value):
        begin = best[i] + (config.part_cost if i else 0)
        has = _class(char)
        for c in sets:
            spans[c] = min(spans[c], begin) + _EACH[c] if c >> has & 1 else math.inf
        best[i + 1] = min(best[i + 1], *spans.values())
        for j, cost, _ in part_costs(value, i, config, runs, words):
            best[j] = min(best[j], begin + cost)
    return best[-1]


def base_spans(text: str, config: SecretConfig = SecretConfig()) -> list[tuple[int, int, int]]:
    """start, number of the kind, end; in order."""
    low = text.lower()
    out = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(h in low for h in ("passw", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= config.min_assign]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return sorted(out)


def spans(text: str | None, config: SecretConfig = SecretConfig(), words: Ranks = WORDS) -> list[tuple[int, int, int, float]]:
    """start, number of the kind, end, log10 guesses of the value; in order."""
    if not text:
        return []
    base = base_spans(text, config)
    out = []
    for start, kind, end in base:
        value = ASSIGN.match(text, start)[2] if kind == 0 else text[start:end]
        out.append((start, kind, end, guess_cost(value, config, words)))
    low = text.lower()
    if any(h in low for h in _HINTS):
        for m in CONTEXT.finditer(text):
            value = m[1].rstrip(".!?)|")
            a, b = m.start(1), m.start(1) + len(value)
            if len(value) < config.min_value or any(s <= a and b <= e for s, _, e in base):
                continue
            cost = guess_cost(value, config, words)
            if cost >= config.min_log10_guesses:
                out.append((a, 3, b, cost))
    return sorted(out)


def word_ranks(docs: DataFrame, text_col: str = "text", config: SecretConfig = SecretConfig()) -> Ranks:
    """The words of the corpus by the number of texts that hold them outside credential contexts, and WORDS."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    outside = F.when(text.rlike(f"(?i){'|'.join(_HINTS)}"), F.regexp_replace(text, CONTEXT.pattern, " ")).otherwise(text)
    each = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(outside), F.lit(_CORPUS_WORD), F.lit(0)))).alias("word"))
    often = stored(each.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= config.min_docs), "secret-words")
    least, room = None, config.max_words
    for n, words in sorted(map(tuple, often.groupBy("n").agg(F.count("*").alias("words")).collect()), reverse=True):  # a row a count
        if (room := room - words) < 0:
            break
        least = n
    rows = often.filter(F.col("n") >= least).collect() if least is not None else []  # max_words at most; words of one count go together
    ranks = {r["word"]: k + 1 for k, r in enumerate(sorted(rows, key=lambda r: (-r["n"], r["word"])))}
    return Ranks(ranks | {w: min(k, ranks.get(w, k)) for w, k in WORDS.items()})


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: SecretConfig = SecretConfig()) -> DataFrame:
    """Per row: id and ``found``, an array of (kind, start, end, log10_guesses)."""
    shared = docs.sparkSession.sparkContext.broadcast(dict(word_ranks(docs, text_col, config)))  # max_words, whatever the corpus
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("log10_guesses", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Ranks(shared.value)
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e, "log10_guesses": c} for s, k, e, c in spans(t.as_py(), config, words)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(item))], names=[id_col, "found"])

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, found array<struct<kind: string, start: long, end: long, log10_guesses: double>>"
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def span_digests(found: DataFrame, id_col: str, base: tuple[str, ...], *more: str) -> DataFrame:
    """Counts of the base kinds, base_sha256 and spans from an ordered ``found`` column, and ``more`` columns."""
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(id_col, *map(of, base), F.sha2(joined(F.filter("found", lambda x: x["kind"].isin(*base))), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), *more)


def brute_force(text: str | None) -> tuple[int, int, int, str]:
    """The base columns of one text by the plain patterns, for tests."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    said = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))
    return (*(sum(k == x for _, x, _ in found) for k in range(3)), hashlib.sha256(said.encode()).hexdigest())
