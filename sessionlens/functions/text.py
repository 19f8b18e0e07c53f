"""Text expressions. White space is that of Unicode unless a name says otherwise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Phrases that hand over to a speaker.
CALL_PATTERNS = ("la parole est à", "je donne la parole à", "vous avez la parole")
# Phrases that only the chair says.
CHAIR_PATTERNS = (
    "la parole est à",
    "je donne la parole à",
    "vous avez la parole",
    "la séance est ouverte",
    "la séance est levée",
    "l'ordre du jour appelle",
    "le scrutin est ouvert",
    "le scrutin est clos",
    "je vais mettre aux voix",
    "je mets aux voix",
)
MONTHS = ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


@F.pandas_udf(StringType())
def without_accents(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks; no built-in does this."""
    return text.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)))


def normalize_name(text: Column) -> Column:
    return squeeze(without_accents(F.lower(text)))


def split_sentences(text: Column) -> Column:
    """Parts between runs of . ! ?, stripped, empty ones left out."""
    return F.filter(F.transform(F.split(text, r"[.!?]+"), strip), lambda s: s != "")


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\S+")).cast("long")


def count_chars(text: Column) -> Column:
    """Characters that aren't white space."""
    return F.length(F.regexp_replace(text, r"(?U)\s+", "")).cast("long")


def count_bytes(text: Column) -> Column:
    """Bytes in UTF-8 without ASCII white space."""
    return F.octet_length(F.regexp_replace(text, "[ \\t\\n\\r\\x0b\\f]", "")).cast("long")


def sentence_context(text: Column, start: Column, end: Column) -> Column:
    """Lower-case sentence around text[start:end], and where the part lies in it."""
    before = F.substring(text, F.lit(1), start)
    lead = F.length(F.regexp_extract(before, r"(?s)^(.*[.?!])?", 0))
    after = F.substring(text, end + 1, F.length(text))
    tail = F.length(F.regexp_extract(after, r"(?s)^[^.?!]*", 0))
    return F.struct(F.lower(F.substring(text, lead + 1, end + tail - lead)).alias("sentence"), (start - lead).alias("start"), (end - lead).alias("end"))


def context_window(text: Column, start: Column, end: Column, radius: int = 80) -> Column:
    low = F.greatest(F.lit(0), start - radius)
    return F.lower(F.substring(text, low + 1, F.least(F.length(text), end + radius) - low))


def last_place(text: Column, *patterns: str) -> Column:
    """Code points before the last occurrence of any pattern; null if there is none."""
    back = F.reverse(text)
    places = [F.when(F.contains(text, F.lit(p)), F.length(text) - F.instr(back, p[::-1]) + 1 - len(p)) for p in patterns]
    return F.greatest(*places) if len(places) > 1 else places[0]


def contains_any(text: Column, patterns: tuple[str, ...] = CHAIR_PATTERNS) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for p in patterns:
        out = out | F.contains(low, F.lit(p))
    return F.coalesce(out, F.lit(False))


def title_of(stem: Column) -> Column:
    """A title from a file stem: no trailing date, dashes as spaces, a capital first."""
    bare = F.regexp_replace(stem, r"-\d{1,2}-[a-zéû]+-\d{4}$", "")
    spaced = squeeze(F.regexp_replace(F.regexp_replace(bare, "--", " - "), "(?<! )-(?! )", " "))
    return F.concat(F.upper(F.substring(spaced, 1, 1)), F.substring(spaced, F.lit(2), F.length(spaced)))


def french_date(stem: Column) -> Column:
    """Date at the end of a stem, as -14-avril-2026; null without one or with an unknown month."""
    part = lambda k: F.regexp_extract(stem, r"-(\d{1,2})-([a-zéû]+)-(\d{4})$", k)
    month = F.array_position(F.array(*map(F.lit, MONTHS)), part(2)).cast("int")
    text = F.format_string("%s-%02d-%02d", part(3), month, part(1).cast("int"))
    return F.when((part(1) != "") & (month > 0), F.try_to_date(text, "yyyy-MM-dd"))


# Months as file names spell them, with and without accents.
MONTH_NUMBERS = {
    **{name: k for k, name in enumerate(MONTHS, 1)},
    "fevrier": 2,
    "aout": 8,
    "decembre": 12,
}
#: Dates in a stem, in the order in which they are tried: ISO, eight digits, French.
ISO_DATE = r"(?<!\d)(\d{4})-(\d{2})-(\d{2})(?!\d)"
COMPACT_DATE = r"(?<!\d)(\d{4})(\d{2})(\d{2})(?!\d)"
FRENCH_DATE = rf"(?iu)(?<!\d)(\d{{1,2}})[-_ ]+({'|'.join(sorted(MONTH_NUMBERS, key=len, reverse=True))})[-_ ]+(\d{{4}})(?!\d)"


def _date_text(stem: Column) -> Column:
    """The part of a stem that is its date; '' without one."""
    iso, compact, french = (F.regexp_extract(stem, p, 0) for p in (ISO_DATE, COMPACT_DATE, FRENCH_DATE))
    return F.when(iso != "", iso).when(compact != "", compact).otherwise(french)


def stem_date(stem: Column) -> Column:
    """ISO date text found in a stem: ISO form, else eight digits, else French; not checked against the calendar."""
    part = lambda p, k: F.regexp_extract(stem, p, k)
    numbers = F.create_map(*[F.lit(x) for pair in MONTH_NUMBERS.items() for x in pair])
    month = F.element_at(numbers, F.lower(part(FRENCH_DATE, 2)))
    french = F.when(month.isNotNull(), F.format_string("%s-%02d-%02d", part(FRENCH_DATE, 3), month, part(FRENCH_DATE, 1).cast("int")))
    plain = lambda p: F.concat_ws("-", part(p, 1), part(p, 2), part(p, 3))
    return F.when(part(ISO_DATE, 0) != "", plain(ISO_DATE)).when(part(COMPACT_DATE, 0) != "", plain(COMPACT_DATE)).otherwise(french)


def slug_of(stem: Column) -> Column:
    """Lower-case ASCII slug of a stem without the text of its date; "session" if nothing is left."""
    found = _date_text(stem)
    bare = F.when(found != "", F.replace(stem, found, F.lit(" "))).otherwise(stem)
    ascii_only = F.regexp_replace(without_accents(bare), r"[^\x00-\x7F]", "")
    plain = F.regexp_replace(F.lower(ascii_only), r"[^a-z0-9]+", "-")
    plain = F.regexp_replace(plain, r"^-+|-+$", "")
    return F.when(plain == "", F.lit("session")).otherwise(plain)


def join_parts(parts: Column) -> Column:
    """Parts joined by spaces, runs of white space folded, none before punctuation."""
    return F.regexp_replace(squeeze(F.array_join(parts, " ")), r"\s+([,.;:!?])", "$1")


def token_norm(token: Column) -> Column:
    return F.regexp_replace(F.lower(strip(token)), r"(?U)[^\wÀ-ÿ']", "")


def ends_sentence(text: Column) -> Column:
    return strip(text).rlike(r"[.!?…]$")


def is_punctuation(token: Column) -> Column:
    """Empty, or nothing but characters that are neither letters, digits nor white space."""
    return strip(token).rlike(r"(?U)^[^\w\s]*$")


def clock(seconds: Column) -> Column:
    """HH:MM:SS.ss; the seconds are rounded on their own and may print as 60.00."""
    whole = F.floor(seconds)
    return F.format_string("%02d:%02d:%05.2f", F.floor(whole / 3600).cast("int"), F.floor((whole % 3600) / 60).cast("int"), seconds - F.floor(seconds / 60) * 60)


def clock_rounded(seconds: Column) -> Column:
    """HH:MM:SS of the seconds rounded half to even."""
    s = F.rint(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", (F.floor(s / 3600)).cast("int"), F.floor((s % 3600) / 60).cast("int"), (s % 60).cast("int"))


def cer(hypothesis: Column, reference: Column) -> Column:
    """Character error rate: edit distance over the reference's length."""
    return F.when(F.length(reference) > 0, F.levenshtein(hypothesis, reference) / F.length(reference))


def edits(a: list[str] | str, b: list[str] | str) -> int:
    """Edit distance of two lists or strings, a whole column of the table at a time in two integers (Myers, Hyyrö)."""
    if not b:
        return len(a)
    where: dict[str, int] = {}
    for i, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << i
    full, last, found = (1 << len(b)) - 1, len(b) - 1, len(b)
    up, down = full, 0
    for x in a:
        same = where.get(x, 0)
        flat = (((same & up) + up) ^ up) | same | down
        plus, minus = (down | ~(flat | up)) & full, up & flat
        found += (plus >> last & 1) - (minus >> last & 1)
        plus, minus = plus << 1 | 1, minus << 1
        up, down = (minus | ~(flat | plus)) & full, plus & flat & full
    return found


@F.pandas_udf(DoubleType())
def cer_of_texts(hypothesis: pd.Series, reference: pd.Series) -> pd.Series:
    """``cer`` of texts of many words, in fewer steps."""
    return pd.Series([edits(h, r) / len(r) if h is not None and r else None for h, r in zip(hypothesis, reference, strict=True)], dtype=float)


@F.pandas_udf(DoubleType())
def wer(hypothesis: pd.Series, reference: pd.Series) -> pd.Series:
    """Word error rate: edit distance of the words over the reference's words."""

    def one(h: str | None, r: str | None) -> float | None:
        if h is None or r is None or not r.split():
            return None
        b = r.split()
        return edits(h.split(), b) / len(b)

    return pd.Series([one(h, r) for h, r in zip(hypothesis, reference, strict=True)])
