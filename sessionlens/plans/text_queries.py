"""Queries over texts: sentences, shapes, names, dates, slugs, flags, hand-offs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import flags, text
from ..functions.fuzzy import weighted_ratio
from ..sources.adapters import table
from .registry import query

_SPLIT = r"list_filter(list_transform(regexp_split_to_array(text, '[.!?]+'), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"


@query("sentence_split", f"SELECT conv_id, turn, CAST(unnest(range(len({_SPLIT}))) AS INTEGER) AS sentence_index, unnest({_SPLIT}) AS sentence FROM conversations")
def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(text.split_sentences(F.col("text"))).alias("sentence_index", "sentence"))


@query(
    "text_shape",
    r"""SELECT doc_id, CAST(length(regexp_replace(text, '\s+', '', 'g')) AS BIGINT) AS chars, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS words, CAST(strlen(regexp_replace(text, '[ \t\n\r\x0b\f]', '', 'g')) AS BIGINT) AS bytes FROM documents""",
)
def text_shape(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", text.count_chars(t).alias("chars"), text.count_words(t).alias("words"), text.count_bytes(t).alias("bytes"))


@query("normalize_name", r"SELECT c_custkey, name, trim(regexp_replace(strip_accents(lower(name)), '\s+', ' ', 'g')) AS normalized FROM (SELECT c_custkey, c_name || '  ' || n_name || '  É' || c_mktsegment || ' ñ Ærøskøbing ' AS name FROM customer JOIN nation ON c_nationkey = n_nationkey)")
def normalize_name(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    name = F.concat("c_name", F.lit("  "), "n_name", F.lit("  É"), "c_mktsegment", F.lit(" ñ Ærøskøbing "))
    return rows.select("c_custkey", name.alias("name")).withColumn("normalized", text.normalize_name(F.col("name")))


@query("french_words_normalized", r"SELECT doc_id, regexp_replace(strip_accents(lower(text)), '\s+', ' ', 'g') AS normalized FROM documents WHERE lang = 'fr'")
def french_words_normalized(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter("lang = 'fr'")
    return rows.select("doc_id", F.regexp_replace(text.without_accents(F.lower("text")), r"\s+", " ").alias("normalized"))


#: File stems from the days of events, in six forms; the SQL knows each stem's date from the event itself.
_MONTHS = "['" + "','".join(text.MONTHS) + "']"
_PLAIN = "['" + "','".join({"février": "fevrier", "août": "aout", "décembre": "decembre"}.get(m, m) for m in text.MONTHS) + "']"
_STEMS_SQL = f"""days AS (SELECT event_id, CAST(ts AS DATE) + CAST(event_id * 7 % 366 AS INTEGER) AS day, event_id % 6 AS form FROM events),
    stems AS (SELECT *, CASE form WHEN 0 THEN 'Qag-' || strftime(day, '%Y-%m-%d') || '-suite' WHEN 1 THEN 'qag_' || strftime(day, '%Y%m%d') || '_suite'
      WHEN 2 THEN 'QAG ' || day(day) || ' ' || {_MONTHS}[month(day)] || '  ' || year(day) || ' suitè' WHEN 3 THEN '2ème-seance--qag-' || day(day) || '-' || {_MONTHS}[month(day)] || '-' || year(day)
      WHEN 4 THEN 'qag_' || day(day) || '_' || upper({_PLAIN}[month(day)]) || '_' || year(day) || '_n°3' ELSE 'Séance plénière n° 7' END AS stem FROM days)"""


def _stems(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_add(F.to_date(F.col("ts").cast("timestamp_ntz")), (F.col("event_id") * 7 % 366).cast("int"))
    rows = table(spark, d, "events").select("event_id", day.alias("day"), (F.col("event_id") % 6).alias("form"))
    name = lambda plain: F.element_at(F.array(*[F.lit({"février": "fevrier", "août": "aout", "décembre": "decembre"}.get(m, m) if plain else m) for m in text.MONTHS]), F.month("day"))
    n, year, f = F.dayofmonth("day"), F.year("day"), F.col("form")
    french = F.when(f == 2, F.concat(F.lit("QAG "), n, F.lit(" "), name(False), F.lit("  "), year, F.lit(" suitè"))).when(f == 3, F.concat(F.lit("2ème-seance--qag-"), n, F.lit("-"), name(False), F.lit("-"), year))
    french = french.when(f == 4, F.concat(F.lit("qag_"), n, F.lit("_"), F.upper(name(True)), F.lit("_"), year, F.lit("_n°3"))).otherwise("Séance plénière n° 7")
    stem = F.when(f == 0, F.concat(F.lit("Qag-"), F.date_format("day", "yyyy-MM-dd"), F.lit("-suite"))).when(f == 1, F.concat(F.lit("qag_"), F.date_format("day", "yyyyMMdd"), F.lit("_suite"))).otherwise(french)
    return rows.select("event_id", "form", stem.alias("stem"))


@query("french_date", f"WITH {_STEMS_SQL} SELECT event_id, stem, CASE WHEN form = 3 THEN strftime(day, '%Y-%m-%d') END AS day FROM stems")
def french_date(spark: SparkSession, d: str) -> DataFrame:
    return _stems(spark, d).select("event_id", "stem", text.french_date(F.col("stem")).cast("string").alias("day"))


@query("stem_dates_and_slugs", f"WITH {_STEMS_SQL} SELECT event_id, stem, CASE WHEN form < 5 THEN strftime(day, '%Y-%m-%d') END AS day, ['qag-suite', 'qag-suite', 'qag-suite', '2eme-seance-qag', 'qag-n3', 'seance-pleniere-n-7'][form + 1] AS slug FROM stems")
def stem_dates_and_slugs(spark: SparkSession, d: str) -> DataFrame:
    return _stems(spark, d).select("event_id", "stem", text.stem_date(F.col("stem")).alias("day"), text.slug_of(F.col("stem")).alias("slug"))


@query("title_from_slug", f"WITH {_STEMS_SQL} SELECT event_id, CASE form WHEN 0 THEN 'Qag ' || strftime(day, '%Y %m %d') || ' suite' WHEN 1 THEN 'Q' || substr(stem, 2) WHEN 2 THEN replace(stem, '  ', ' ') WHEN 3 THEN '2ème seance - qag' WHEN 4 THEN 'Q' || substr(stem, 2) ELSE stem END AS title FROM stems")
def title_from_slug(spark: SparkSession, d: str) -> DataFrame:
    return _stems(spark, d).select("event_id", text.title_of(F.col("stem")).alias("title"))


@query(
    "clock_format",
    """SELECT event_id, format('{:02d}:{:02d}:{:05.2f}', CAST(floor(value / 3600) AS BIGINT), CAST(floor((floor(value) % 3600) / 60) AS BIGINT), value - floor(value / 60) * 60) AS clock FROM events""",
)
def clock_format(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", text.clock(F.col("value")).alias("clock"))


@query(
    "flag_names",
    "WITH f AS (SELECT event_id, CAST((event_id * 37) % 16 + (event_id % 3) * 1024 + (event_id % 5 // 4) * 1073741824 AS BIGINT) AS flags FROM events), d AS (SELECT * FROM (VALUES "
    + ", ".join(f"({b}, '{n}', CAST({1 << b} AS BIGINT))" for n, (b, _) in flags.FLAGS.items())
    + ") AS v(bit, name, value)) SELECT event_id, flags, coalesce((SELECT string_agg(name, ',' ORDER BY bit) FROM d WHERE f.flags & d.value <> 0), '') AS names FROM f",
)
def flag_names(spark: SparkSession, d: str) -> DataFrame:
    rows = _flagged(spark, d)
    return rows.select("event_id", "flags", F.array_join(flags.flag_names(F.col("flags")), ",").alias("names"))


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    value = (e * 37) % 16 + (e % 3) * 1024 + F.floor((e % 5) / 4) * (1 << 30)
    return table(spark, d, "events").select("event_id", value.cast("long").alias("flags"))


_FLAGGED = "fl AS (SELECT event_id, CAST((event_id * 37) % 16 + (event_id % 3) * 1024 + (event_id % 5 // 4) * 1073741824 AS BIGINT) AS flags FROM events), dm AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', CAST({1 << b} AS BIGINT))" for n, (b, _) in flags.FLAGS.items()) + ") AS v(name, value))"


@query("flag_histogram", f"WITH {_FLAGGED} SELECT name, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM fl WHERE flags <> 0), 2) AS percent FROM fl JOIN dm ON flags & value <> 0 GROUP BY name")
def flag_histogram(spark: SparkSession, d: str) -> DataFrame:
    rows = _flagged(spark, d).filter("flags <> 0")
    total = rows.agg(F.count("*").alias("total"))
    each = rows.select(F.explode(flags.flag_names(F.col("flags"))).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    return each.crossJoin(F.broadcast(total)).select("name", "n", F.round(100.0 * F.col("n") / F.col("total"), 2).alias("percent"))  # one row


@query("flag_combinations", f"WITH {_FLAGGED} SELECT flags, count(*) AS n FROM fl WHERE flags <> 0 GROUP BY flags")
def flag_combinations(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d).filter("flags <> 0").groupBy("flags").agg(F.count("*").alias("n"))


@query("clean_ratio", f"WITH {_FLAGGED} SELECT count(*) AS n, count(*) FILTER (WHERE flags = 0) AS clean, round(100.0 * count(*) FILTER (WHERE flags = 0) / count(*), 2) AS percent FROM fl")
def clean_ratio(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d).agg(F.count("*").alias("n"), F.count_if(F.col("flags") == 0).alias("clean"), F.round(100.0 * F.count_if(F.col("flags") == 0) / F.count("*"), 2).alias("percent"))


# Turns with a phrase in their middle, another for each turn number; every so many have none.
def _phrase_sql(phrases: tuple[str, ...]) -> str:
    listed = ", ".join("'" + p.replace("'", "''") + "'" for p in (*phrases, "merci"))
    return f"text || '. Alors ' || [{listed}][CAST(turn % {len(phrases) + 1} AS INTEGER) + 1] || ' ' || text"


def _with_phrase(phrases: tuple[str, ...]) -> Column:
    phrase = F.element_at(F.array(*map(F.lit, (*phrases, "merci"))), (F.col("turn") % (len(phrases) + 1)).cast("int") + 1)
    return F.concat("text", F.lit(". Alors "), phrase, F.lit(" "), "text")


_LAST = ", ".join(f"CASE WHEN contains(said, '{p}') THEN length(said) - strpos(reverse(said), reverse('{p}')) + 1 - length('{p}') END" for p in text.CALL_PATTERNS)


@query("handoff_anchor", f"WITH s AS (SELECT conv_id, turn, lower({_phrase_sql(text.CALL_PATTERNS)}) AS said FROM conversations) SELECT conv_id, turn, coalesce(CAST(greatest({_LAST}) AS INTEGER), -1) AS anchor FROM s")
def handoff_anchor(spark: SparkSession, d: str) -> DataFrame:
    said = F.lower(_with_phrase(text.CALL_PATTERNS))
    return table(spark, d, "conversations").select("conv_id", "turn", F.coalesce(text.last_place(said, *text.CALL_PATTERNS), F.lit(-1)).alias("anchor"))


@query("chair_turns", f"""WITH s AS (SELECT conv_id, turn, lower({_phrase_sql(text.CHAIR_PATTERNS)}) AS said FROM conversations) SELECT conv_id, turn, {" OR ".join("contains(said, '" + p.replace("'", "''") + "')" for p in text.CHAIR_PATTERNS)} AS chair FROM s""")
def chair_turns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select("conv_id", "turn", text.contains_any(_with_phrase(text.CHAIR_PATTERNS)).alias("chair"))


@query(
    "sentence_contexts",
    r"""WITH s AS (SELECT conv_id, turn, text, length(text) // 2 AS a, least(length(text), length(text) // 2 + 5) AS b FROM conversations),
    l AS (SELECT *, length(regexp_extract(substr(text, 1, a), '(?s)^.*[.?!]')) AS lead, length(regexp_extract(substr(text, b + 1), '(?s)^[^.?!]*')) AS tail FROM s)
    SELECT conv_id, turn, lower(substr(text, lead + 1, b + tail - lead)) AS sentence, CAST(a - lead AS INTEGER) AS first, CAST(b - lead AS INTEGER) AS last FROM l""",
)
def sentence_contexts(spark: SparkSession, d: str) -> DataFrame:
    a = F.floor(F.length("text") / 2).cast("int")
    c = text.sentence_context(F.col("text"), a, F.least(F.length("text"), a + 5))
    return table(spark, d, "conversations").select("conv_id", "turn", c["sentence"].alias("sentence"), c["start"].alias("first"), c["end"].alias("last"))


_TOKENS = r"regexp_extract_all(text, '[^\s\x0b]+')"


@query("token_normal_forms", rf"WITH t AS (SELECT conv_id, turn, unnest({_TOKENS}) AS token, CAST(unnest(range(len({_TOKENS}))) AS INTEGER) AS position FROM conversations) SELECT conv_id, turn, position, regexp_replace(lower(token), '[^\p{{L}}\p{{N}}_'']', '', 'g') AS token FROM t")
def token_normal_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every token of every turn with its place from 0."""
    tokens = F.regexp_extract_all("text", F.lit(r"(?U)\S+"), F.lit(0))
    return table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(tokens).alias("position", "token")).withColumn("token", text.token_norm(F.col("token")))


@query("cer_names", "SELECT c_custkey, levenshtein(c_name, s_name) AS distance, round(levenshtein(c_name, s_name) / length(s_name), 6) AS cer FROM customer JOIN supplier ON c_custkey = s_suppkey")
def cer_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").join(table(spark, d, "supplier"), F.col("c_custkey") == F.col("s_suppkey"))
    return rows.select("c_custkey", F.levenshtein("c_name", "s_name").cast("long").alias("distance"), F.round(text.cer(F.col("c_name"), F.col("s_name")), 6).alias("cer"))


@query("wer_cer")
def wer_cer(spark: SparkSession, d: str) -> DataFrame:
    """Each turn against the one before it."""
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("a"), before.alias("b")).filter("b is not null")
    return rows.select("conv_id", "turn", text.wer("a", "b").alias("wer"), text.cer_of_texts("a", "b").alias("cer"), weighted_ratio("a", "b").alias("wratio"))
