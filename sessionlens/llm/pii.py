r"""Personal data in texts: four fixed patterns, and identifiers found by their contexts.

Everything here is made of DataFrame functions; no row passes through Python.

Base kinds: ``email``, ``ip`` (parts at most 255), ``card`` (14 to 19 digits that pass Luhn)
and ``phone`` (10 to 15 digits), each matched leftmost and without overlaps; a match that
fails its test is dropped. The patterns are written with possessive loops and look-behinds,
which match the same spans but take linear time and no stack on long runs.

Bootstrapping: base spans are the seeds, and candidates are the words outside them that look like
identifiers: those with a digit, ``@`` or ``_``, or a dot or colon between letters, and digits
in groups. The pattern of either is its two words to the left, digits folded to 0. Over the
graph of patterns and distinct seeds and candidates, patterns are scored by the mean score of their candidates
and candidates by the best of their patterns, in turns, until the scores stand still; seeds keep
the score 1, so that no score ever falls. Candidates under a pattern of high confidence and with
enough seeds become spans of the kind ``learned``. Words of letters alone are no candidates, as
any word of prose would be one.

Places of n matches are sums over blocks of their square root, so that a text of many matches
takes n^1.5 steps and not n^2.

Positions are code points, ends exclusive. Defined results: null and empty texts have no
spans; repeated rows give repeated results; an empty table gives an empty result; columns
besides id and text are not read by ``spans_found`` and unchanged by ``masked``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

BASE = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Digits in groups, or a word with a digit, @ or _, or with a dot or colon between letters.
CANDIDATE = r"(?<!\S)(?:[0-9]{1,4}(?:\x20[0-9]{1,4})++(?!\S)|(?=\S*?[0-9@_]|\S*?\p{L}[.:]\p{L})\S++)"
SPAN = "array<struct<kind: string, start: int, end: int>>"


@dataclass(frozen=True)
class PiiConfig:
    most_rounds: int = 100  # scores grow to their limits by a constant share a round
    still: float = 1e-6  # growth of the sum of confidences at which they stand still
    min_confidence: float = 0.8
    min_seeds: int = 3  # distinct seed candidates of a pattern


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    value = lambda i: F.substring(back, i, 1).cast("int")
    terms = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.when(i % 2 == 1, value(i)).otherwise(value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0)))
    return F.aggregate(terms, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(r"^(0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(\.|$)){4}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _blocks(values: Column) -> Column:
    """An array, not empty, in parts of about the square root of its size."""
    size = F.size(values)
    return _let(F.ceil(F.sqrt(size)).cast("int"), lambda b: F.transform(F.sequence(F.lit(0), F.ceil(size / b).cast("int") - 1), lambda k: F.slice(values, k * b + 1, b)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def placed(text: Column, pattern: str) -> Column:
    """Matches with their places: array of (match, before, start); ``before`` is the text since the last match.

    What stands between matches comes from a split by the same pattern, so that lengths add
    up to positions.
    """
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.transform(F.arrays_zip(matches.alias("match"), between.alias("before")), lambda x: F.struct(x["match"].alias("match"), x["before"].alias("before"), (F.length(x["before"]) + F.length(x["match"])).alias("step")))
    pairs = F.filter(pairs, lambda x: x["match"].isNotNull())  # what follows the last match

    def part(block: Column, begin: Column) -> Column:
        steps = F.transform(block, lambda x: x["step"])
        return _let(steps, lambda step: F.transform(block, lambda x, i: F.struct(x["match"].alias("match"), x["before"].alias("before"), (begin + _sum(F.slice(step, F.lit(1), i)) + F.length(x["before"])).alias("start"))))

    def all_parts(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda block: _sum(F.transform(block, lambda x: x["step"])))
        return _let(sums, lambda total: F.flatten(F.transform(blocks, lambda block, k: _let(_sum(F.slice(total, F.lit(1), k)), lambda begin: part(block, begin)))))

    empty = F.array().cast("array<struct<match: string, before: string, start: int>>")
    return F.when(text.rlike(pattern), _let(pairs, lambda p: _let(_blocks(p), all_parts))).otherwise(empty)


def base_marks(text: Column) -> Column:
    """Matches of the base kinds, ordered by start and then by kind as listed: array of (start, no, end, match, before)."""

    def of(no: int, kind: str) -> Column:
        good = F.filter(placed(text, PATTERNS[kind]), lambda x: _valid(kind, x["match"]))
        return F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(no).alias("no"), (x["start"] + F.length(x["match"])).alias("end"), x["match"].alias("match"), x["before"].alias("before")))

    return F.array_sort(F.concat(*[of(k, kind) for k, kind in enumerate(BASE)]))


def base_spans(text: Column) -> Column:
    """Spans of the base kinds, ordered by start and then by kind as listed."""
    return _named(base_marks(text), BASE)


def _named(spans: Column, kinds: tuple[str, ...]) -> Column:
    names = F.array(*map(F.lit, kinds))
    return F.transform(spans, lambda x: F.struct(F.element_at(names, x["no"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def _pattern(before: Column, first: Column) -> Column:
    """The last two words before an instance; another instance of its kind counts as <id>."""
    near = F.when(first, before).otherwise(F.concat(F.lit("<id>"), before))
    words = F.reverse(F.regexp_extract(F.reverse(near), r"^\s*+\S++(?:\s++\S++)?", 0))
    return F.lower(F.regexp_replace(F.regexp_replace(words, r"[0-9]", "0"), r"\s+", " "))


def candidates(text: Column, marks: Column) -> Column:
    """Seeds (base spans), and words with many digits outside them: array of (pattern, instance, start, end, seed)."""

    def of(x: Column, i: Column) -> Column:
        word = F.regexp_replace(x["match"], r"^[^\p{L}\p{N}+(]+|[^\p{L}\p{N})]+$", "")
        start = x["start"] + F.length(F.regexp_extract(x["match"], r"^[^\p{L}\p{N}+(]+", 0))
        return F.struct(_pattern(x["before"], i == 0).alias("pattern"), word.alias("instance"), start.alias("start"), (start + F.length(word)).alias("end"), F.lit(False).alias("seed"))

    seeds = F.transform(marks, lambda m: F.struct(_pattern(m["before"], m["start"] == F.length(m["before"])).alias("pattern"), m["match"].alias("instance"), m["start"].alias("start"), m["end"].alias("end"), F.lit(True).alias("seed")))
    words = F.filter(F.transform(placed(text, CANDIDATE), of), lambda x: x["instance"] != "")
    span = F.transform(marks, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
    parts = lambda m: F.transform(_blocks(m), lambda p: F.struct(F.get(p, F.lit(0))["start"].alias("start"), F.array_max(F.transform(p, lambda x: x["end"])).alias("end"), p.alias("part")))
    meets = lambda a, x: (a["start"] < x["end"]) & (x["start"] < a["end"])
    outside = lambda found, blocks: F.filter(found, lambda x: ~F.exists(blocks, lambda p: meets(p, x) & F.exists(p["part"], lambda m: meets(m, x))))
    clear = F.when((F.size(marks) == 0) | ~text.rlike(CANDIDATE), words).otherwise(_let(span, lambda m: _let(parts(m), lambda p: outside(words, p))))
    return F.concat(seeds, clear)


def _first_pass(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, base spans, seeds and candidates, and, for texts that have some, a key of the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    has = docs.select(*keep, text.alias("text")).withColumn("marks", base_marks(F.col("text")))
    has = has.withColumn("found", candidates(F.col("text"), F.col("marks")))
    return has.select(*keep, _named(F.col("marks"), BASE).alias("base"), "found", F.when(F.size("found") > 0, F.sha2("text", 256)).alias("key"))


def learned_patterns(first: DataFrame, config: PiiConfig = PiiConfig()) -> tuple[DataFrame, DataFrame]:
    """Patterns of high confidence, and the occurrences of candidates in distinct texts."""
    places = first.filter("key is not null").select("key", F.inline("found")).filter("pattern <> ''").distinct()
    places = stored(places, "pii-candidates")
    graph = stored(places.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-graph")
    scores = graph.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    good, before = None, 0.0
    for _ in range(config.most_rounds):
        patterns = graph.join(scores, "instance").groupBy("pattern").agg(F.avg("score").alias("confidence"), F.sum(F.col("seed").cast("int")).alias("seeds"))
        good = stored(patterns.filter((F.col("confidence") >= config.min_confidence) & (F.col("seeds") >= config.min_seeds)), "pii-patterns")
        now = good.agg(F.coalesce(F.sum("confidence"), F.lit(0.0)).alias("sum")).collect()[0]["sum"]
        if now <= before + config.still:
            break
        before = now
        sure = F.coalesce("confidence", F.lit(0.0))
        scores = stored(graph.join(good.select("pattern", "confidence"), "pattern", "left").groupBy("instance").agg(F.max(F.when(F.col("seed"), 1.0).otherwise(sure)).alias("score")), "pii-scores")
    return good, places


def _learned_spans(first: DataFrame, config: PiiConfig) -> DataFrame:
    """key and ``learned``, the spans that contexts give, of texts that have some."""
    good, places = learned_patterns(first, config)
    hits = places.filter("not seed").join(good, "pattern", "left_semi")
    return hits.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", F.lit(len(BASE)).alias("no"), "end"))).alias("learned"))


def _merged(base: Column, learned: Column) -> Column:
    number = F.create_map(*[x for k, name in enumerate(BASE) for x in (F.lit(name), F.lit(k))])
    plain = F.transform(base, lambda x: F.struct(x["start"].alias("start"), number[x["kind"]].alias("no"), x["end"].alias("end")))
    return F.when(learned.isNull(), base.cast(SPAN)).otherwise(_named(F.array_sort(F.concat(plain, learned)), (*BASE, "learned")).cast(SPAN))


def spans_found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: PiiConfig = PiiConfig()) -> DataFrame:
    """Per row: id and ``found``, an ordered array of (kind, start, end)."""
    first = stored(_first_pass(docs, text_col, [id_col]), "pii-base")
    learned = _learned_spans(first, config)
    plain = first.filter("key is null").select(id_col, F.col("base").cast(SPAN).alias("found"))
    keyed = first.filter("key is not null").join(learned, "key", "left").select(id_col, _merged(F.col("base"), F.col("learned")).alias("found"))
    return plain.unionByName(keyed)


def _covered(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by <KIND>."""

    def step(a: Column, x: Column) -> Column:
        fresh = x["start"] >= a["at"]
        gap = F.substring(text, a["at"] + 1, x["start"] - a["at"])
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.when(fresh, F.concat(a["out"], gap, F.lit("<"), F.upper(x["kind"]), F.lit(">"))).otherwise(a["out"]).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, begin, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))))


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None, config: PiiConfig = PiiConfig()) -> DataFrame:
    """``docs`` with personal data replaced by <KIND>; ``chars_col``, if named, gets the new length.

    Only texts with candidates are joined with what was learned, so other texts don't move.
    """
    names = docs.columns
    first = stored(_first_pass(docs, text_col, []).filter("key is not null").select("key", "base", "found"), "pii-base")
    learned = _learned_spans(first, config)
    text = F.col(f"row.`{text_col}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).withColumn("base", base_spans(F.coalesce(text.cast("string"), F.lit(""))))
    has = F.coalesce(text.cast("string"), F.lit("")).rlike(CANDIDATE)
    plain = rows.filter(~has).withColumn("found", F.col("base").cast(SPAN))
    keyed = rows.filter(has).withColumn("key", F.sha2(text.cast("string"), 256)).join(learned, "key", "left").select("row", "base", _merged(F.col("base"), F.col("learned")).alias("found"))
    both = plain.unionByName(keyed).withColumn("new", _covered(text, F.col("found")))
    out = {c: F.col(f"row.`{c}`") for c in names} | {text_col: F.col("new")}
    if chars_col is not None:
        out[chars_col] = F.when(F.col("new").isNotNull(), F.length("new").cast(docs.schema[chars_col].dataType)).otherwise(F.col(f"row.`{chars_col}`"))
    return both.select(*[v.alias(c) for c, v in out.items()])
