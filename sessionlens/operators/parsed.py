"""Persons from dependency parses: every token of a person is scored by its place in the parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Points by part of speech, by relation, and by what the head and the children are.
POS_POINTS = {"PROPN": 3}
DEP_POINTS = {"flat:name": 3, "appos": 2, "nsubj": 2, "obl:agent": 2, "vocative": -2}
HEAD_DEP_POINTS = {"obl:agent": 2, "nsubj": 2}
HEAD_POS_POINTS = {"PROPN": 1}
CHILD_POINTS = {"flat:name": 2, "appos": 1}
# Heads in lower case that speak for a person, and their points.
TITLES = ("monsieur", "madame", "m.", "mme", "président", "présidente", "ministre")
TITLE_POINTS = 2
BASE_POINTS, MORE_THAN = 1, 6


def _points(column: Column, points: dict[str, int]) -> Column:
    """The points of a value; 0 if it has none or is null."""
    found = F.lit(0)
    for value, n in points.items():
        found = F.when(column == value, n).otherwise(found)
    return found


def person_candidates(tokens: DataFrame, titles: tuple[str, ...] = TITLES, keys: tuple[str, ...] = ("segment_id",), more_than: int = MORE_THAN) -> DataFrame:
    """Tokens of persons with more than ``more_than`` points, with the name that they belong to.

    tokens: keys, i, text, pos, dep, head_i, ent_type. A flat part of a name has the name of its head,
    another proper noun its own with its flat parts in order, any other token its text. ``titles``: heads in
    lower case that speak for a person.
    """
    ids = [*keys, "i"]
    parts = F.array_sort(F.collect_list(F.when(F.col("dep") == "flat:name", F.struct("i", "text"))))
    below = tokens.filter("head_i is not null").groupBy(*keys, F.col("head_i").alias("i")).agg(F.transform(parts, lambda p: p["text"]).alias("flat"), F.collect_set("dep").alias("below"))
    full = tokens.join(below, ids, "left").withColumn("name", F.concat_ws(" ", F.array(F.col("text")), F.coalesce("flat", F.array().cast("array<string>"))))
    heads = full.select(*keys, F.col("i").alias("head_i"), F.col("text").alias("head_text"), F.col("pos").alias("head_pos"), F.col("dep").alias("head_dep"), F.col("name").alias("head_name"))
    rows = full.filter("ent_type = 'PER'").join(heads, [*keys, "head_i"], "left")
    child = F.lit(0)
    for dep, n in CHILD_POINTS.items():
        child = child + F.when(F.array_contains("below", dep), n).otherwise(0)
    title = F.when(F.lower("head_text").isin(*titles), TITLE_POINTS).otherwise(0) if titles else F.lit(0)
    score = F.lit(BASE_POINTS) + _points(F.col("pos"), POS_POINTS) + _points(F.col("dep"), DEP_POINTS) + _points(F.col("head_dep"), HEAD_DEP_POINTS) + _points(F.col("head_pos"), HEAD_POS_POINTS) + title + child
    name = F.when((F.col("dep") == "flat:name") & (F.col("head_pos") == "PROPN"), F.col("head_name")).when(F.col("pos") == "PROPN", F.col("name")).otherwise(F.col("text"))
    return rows.select(*ids, "text", "pos", "dep", "head_text", score.alias("score"), name.alias("candidate_name")).filter(F.col("score") > more_than).dropDuplicates([*ids, "candidate_name"])


def phrase_persons(segments: DataFrame, entities: DataFrame, phrase: str = "la parole est", keys: tuple[str, ...] = ("segment_id",)) -> DataFrame:
    """Segments that say the phrase, in any case, with the persons named in them in order; an empty list without any.

    entities: keys, ord, label, text.
    """
    named = entities.filter("label = 'PER'").groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda e: e["text"]).alias("persons"))
    said = segments.filter(F.contains(F.lower("text"), F.lit(phrase)))
    return said.join(named, list(keys), "left").withColumn("persons", F.coalesce("persons", F.array().cast("array<string>")))


def shares(df: DataFrame, column: str) -> DataFrame:
    """Rows by value, and their share of all in percent."""
    n = df.groupBy(column).agg(F.count("*").alias("n"))
    return n.join(F.broadcast(df.agg(F.count("*").alias("_all")))).select(column, "n", (F.col("n") * 100.0 / F.col("_all")).alias("percent"))
