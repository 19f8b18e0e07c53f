"""Who a speaker is: mentions, hand-offs, fuzzy names, votes, and majorities."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import Names
from ..functions.text import CALL_PATTERNS, contains_any, last_place, normalize_name, sentence_context

# Mentions that name nobody, as normalised names.
TITLES = (
    "madame la deputee",
    "madame la ministre",
    "madame la presidente",
    "mesdames les deputees",
    "mesdames les ministres",
    "monsieur le depute",
    "monsieur le ministre",
    "monsieur le president",
    "messieurs les deputes",
    "messieurs les ministres",
)
# Kind, id, name and role of the chair; the role of deputies; sources of evidence.
CHAIR = ("assembly_chair", "assembly_chair:yael-braun-pivet", "Yaël Braun-Pivet", "Présidente de l'Assemblée nationale")
DEPUTY_ROLE = "Député"
CHAIR_SOURCE = "hardcoded_assembly_chair"
CALL_SOURCE = "chair_next_speaker_call"
PREVIOUS_SOURCE = "inferred_from_previous_speaker"
SPREAD_SOURCE = "propagated_from_speaker_cluster"
# Prefixes of identifiers, with the spellings that lists have.
CHAIR_PREFIXES = ("assembly_chair:", "assembly_chari:", "assembly_chaii:")


@dataclass(frozen=True)
class IdentityConfig:
    min_entity_score: float = 0.8
    min_match: float = 80.0
    min_token_match: float = 65.0
    look_ahead: int = 5
    next_weight: int = 2
    other_weight: int = 1
    most_people: int = 100_000  # known people; their names are sent to every executor


def person_kind(identifier: Column) -> Column:
    """Kind of a person from the prefix of its identifier."""
    chair = F.lit(False)
    for prefix in CHAIR_PREFIXES:
        chair = chair | identifier.startswith(prefix)
    return F.when(identifier.startswith("minister:"), "minister").when(chair, "assembly_chair").otherwise("deputy")


def known_person(first: Column, last: Column, identifier: Column, role: Column) -> Column:
    """A person struct from the columns of a list of people."""
    return F.struct(identifier.alias("id"), F.concat_ws(" ", first, last).alias("name"), role.alias("role"), person_kind(identifier).alias("kind"))


def person_mentions(entities: DataFrame, config: IdentityConfig = IdentityConfig()) -> DataFrame:
    """Entities that name a person: group PER, a score above the limit, and no mere title."""
    plain = normalize_name(F.col("word"))
    return entities.filter((F.col("entity_group") == "PER") & (F.col("score") > config.min_entity_score) & ~plain.isin(*TITLES))


def looked_ahead(turns: DataFrame, order: str = "turn_id", speaker: str = "speaker_id", keys: tuple[str, ...] = ("session_id",), reach: int = 5) -> DataFrame:
    """Add ``predicted_turn_id``: the first of the next turns with another speaker, else the next turn."""
    by = Window.partitionBy(*keys).orderBy(order)
    steps = [F.when(~F.lead(speaker, k).over(by).eqNullSafe(F.col(speaker)) & F.lead(order, k).over(by).isNotNull(), F.lead(order, k).over(by)) for k in range(1, reach + 1)]
    return turns.withColumn("predicted_turn_id", F.coalesce(*steps, F.lead(order).over(by)))


class TooManyPeople(ValueError):
    """A list of known people beyond the size that is sent to every executor."""


def resolved_names(names: DataFrame, known: DataFrame, config: IdentityConfig = IdentityConfig()) -> DataFrame:
    """Per distinct name: the known person that it means, or the bare normalised name, and its score.

    names: name. known: id, name, role, kind, src_order. Each distinct name is compared with the
    known names, whose number is checked; of people of one name the first listed counts.
    """
    listed = known.withColumn("k", normalize_name(F.col("name"))).orderBy("src_order").limit(config.most_people + 1).collect()
    if len(listed) > config.most_people:
        raise TooManyPeople(f"more than {config.most_people} known people")
    table = Names([r["k"] or "" for r in listed])

    @F.pandas_udf("place int, score double")
    def meant(query: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([table.resolved(q, config.min_match, config.min_token_match) for q in query], columns=["place", "score"]).astype({"place": "Int32", "score": float})

    schema = "place int, id string, known_name string, role string, kind string"
    people = names.sparkSession.createDataFrame([(k, r["id"], r["name"], r["role"], r["kind"]) for k, r in enumerate(listed)], schema)
    asked = names.select("name").distinct().withColumn("q", normalize_name(F.col("name"))).withColumn("m", meant("q"))
    out = asked.select("name", "q", F.col("m.place").alias("place"), F.col("m.score").alias("match_score")).join(F.broadcast(people), "place", "left")  # most_people at most
    return out.select("name", "id", F.coalesce("known_name", "q").alias("resolved_name"), "role", F.coalesce("kind", F.lit("raw_per")).alias("kind"), F.coalesce("match_score", F.lit(0.0)).alias("match_score"), F.col("place").isNotNull().alias("is_known_person"))


def predictions(mentions: DataFrame, turns: DataFrame, config: IdentityConfig = IdentityConfig()) -> DataFrame:
    """Mentions that a hand-off precedes, one for each hand-off, with the turn that they announce.

    mentions: session_id, turn_id, ord, word, start, end. The hand-off is the last calling phrase
    before the mention in its sentence; only the first mention after it counts.
    """
    rows = mentions.join(turns.select("session_id", "turn_id", "text", "speaker_id"), ["session_id", "turn_id"])
    rows = rows.withColumn("c", sentence_context(F.col("text"), F.col("start"), F.col("end")))
    before = F.substring(F.col("c.sentence"), F.lit(1), F.col("c.start"))
    rows = rows.withColumn("anchor", last_place(before, *CALL_PATTERNS)).filter("anchor is not null")
    rows = rows.withColumn("sentence_start", F.col("start") - F.col("c.start"))
    first = F.row_number().over(Window.partitionBy("session_id", "turn_id", "sentence_start", "anchor").orderBy("start", "ord"))
    rows = rows.withColumn("_n", first).filter("_n = 1").select("session_id", "turn_id", "ord", "word", "text", F.lit("probable_next_speaker").alias("role"))
    ahead = looked_ahead(turns, reach=config.look_ahead).select("session_id", "turn_id", "predicted_turn_id")
    return rows.join(ahead, ["session_id", "turn_id"]).filter("predicted_turn_id is not null")


_PERSON = ("kind", "id", "name", "role")


def evidence_of(found: DataFrame, names: DataFrame, turns: DataFrame, config: IdentityConfig = IdentityConfig()) -> DataFrame:
    """Evidence rows: source and target turns and speakers, person, weight, and whether it counts for a majority.

    A hand-off counts as one whoever says it; only one that the chair says counts for a majority.
    """
    source = turns.select("session_id", "turn_id", F.col("speaker_id").alias("source_speaker_id"))
    target = turns.select("session_id", F.col("turn_id").alias("predicted_turn_id"), F.col("speaker_id").alias("target_speaker_id"))
    rows = found.withColumnRenamed("role", "hint").join(source, ["session_id", "turn_id"]).join(target, ["session_id", "predicted_turn_id"]).join(names.withColumnRenamed("name", "word"), "word")
    call = F.col("hint") == "probable_next_speaker"
    known = F.col("is_known_person") if "is_known_person" in names.columns else F.col("kind") != "raw_per"
    return rows.select(
        "session_id",
        "ord",
        F.col("turn_id").alias("source_turn_id"),
        F.col("predicted_turn_id").alias("target_turn_id"),
        "source_speaker_id",
        "target_speaker_id",
        F.when(call, CALL_SOURCE).otherwise(PREVIOUS_SOURCE).alias("source"),
        (call & contains_any(F.col("text"))).alias("eligible_for_cluster_majority"),
        F.struct("kind", "id", F.col("resolved_name").alias("name"), "role").alias("person"),
        F.col("word").alias("speaker_raw"),
        normalize_name(F.col("word")).alias("speaker_normalized"),
        "match_score",
        known.alias("is_known_person"),
        F.when(call, config.next_weight).otherwise(config.other_weight).alias("weight"),
    )


def _chair() -> Column:
    return F.struct(*[F.lit(x).alias(name) for x, name in zip(CHAIR, _PERSON, strict=True)])


def chair_evidence(turns: DataFrame) -> DataFrame:
    """The evidence of the chair's own turns: themselves, by their phrases."""
    return turns.filter(contains_any(F.col("text"))).select(
        "session_id",
        F.lit(0).cast("long").alias("ord"),
        F.col("turn_id").alias("source_turn_id"),
        F.col("turn_id").alias("target_turn_id"),
        F.col("speaker_id").alias("source_speaker_id"),
        F.col("speaker_id").alias("target_speaker_id"),
        F.lit(CHAIR_SOURCE).alias("source"),
        F.lit(True).alias("eligible_for_cluster_majority"),
        _chair().alias("person"),
        F.lit(CHAIR[2]).alias("speaker_raw"),
        normalize_name(F.lit(CHAIR[2])).alias("speaker_normalized"),
        F.lit(100.0).alias("match_score"),
        F.lit(True).alias("is_known_person"),
    )


def turn_evidence(turns: DataFrame, evidence: DataFrame) -> DataFrame:
    """Per turn with some: ``evidence``, its rows in order. A turn of the chair has its own alone."""
    own = chair_evidence(turns)
    others = evidence.join(own.select("session_id", "target_turn_id"), ["session_id", "target_turn_id"], "left_anti")
    fields = [c for c in own.columns if c not in ("session_id", "ord")]
    rows = own.unionByName(others.select(*own.columns))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ord", F.struct(*fields).alias("e")))), lambda x: x["e"])
    return rows.withColumn("turn_id", F.col("target_turn_id")).groupBy("session_id", "turn_id").agg(listed.alias("evidence"))


def majority_evidence(turns: DataFrame, evidence: DataFrame) -> DataFrame:
    """What counts for a speaker's majority: eligible evidence of turns with a speaker, weighted by the turn's length."""
    rows = turn_evidence(turns, evidence).select("session_id", "turn_id", F.explode("evidence").alias("e")).filter("e.eligible_for_cluster_majority")
    length = turns.filter("speaker_id is not null").select("session_id", "turn_id", "speaker_id", (F.col("end_seconds") - F.col("start_seconds")).alias("seconds"))
    key = F.struct(normalize_name(F.col("e.person.name")).alias("normalized_name"), F.col("e.person.kind").alias("kind"))
    return rows.join(length, ["session_id", "turn_id"]).select("session_id", "speaker_id", key.alias("person_key"), "seconds")


def voted(rows: DataFrame, key: list[str], person: str = "person", weight: str = "weight", order: str = "ord") -> DataFrame:
    """Per key the person with most votes, the first seen of equals; votes and purity."""
    sums = rows.groupBy(*key, person).agg(F.sum(weight).alias("votes"), F.min(order).alias("first_seen"))
    by = Window.partitionBy(*key)
    ranked = sums.withColumn("total_votes", F.sum("votes").over(by)).withColumn("_n", F.row_number().over(by.orderBy(F.desc("votes"), "first_seen")))
    return ranked.filter("_n = 1").select(*key, person, "votes", "total_votes", (F.col("votes") / F.col("total_votes")).alias("purity"))


def mentioned(mentions: DataFrame, names: DataFrame) -> DataFrame:
    """Distinct persons of each turn, in the order in which they are first named."""
    rows = mentions.join(names.withColumnRenamed("name", "word"), "word").groupBy("session_id", "turn_id", "kind", "id", "resolved_name").agg(F.min("ord").alias("ord"), F.min_by("role", "ord").alias("role"))
    persons = F.transform(F.array_sort(F.collect_list(F.struct("ord", F.struct("kind", "id", F.col("resolved_name").alias("name"), "role").alias("p")))), lambda x: x["p"])
    return rows.groupBy("session_id", "turn_id").agg(persons.alias("mentioned_persons"))


def turn_identities(turns: DataFrame, evidence: DataFrame) -> DataFrame:
    """The current speaker of each turn: the chair by its phrases, else direct evidence, else the speaker's majority, else nobody.

    The source of direct evidence is the most frequent one of the person that wins.
    """
    turn = ["session_id", "target_turn_id"]
    one = evidence.withColumn("one", F.lit(1))
    direct = voted(one, turn, weight="one").select(*turn, F.col("person").alias("direct"), F.col("purity").alias("direct_purity"))
    source = voted(one, [*turn, "person"], "source", "one").select(*turn, F.col("person").alias("direct"), F.col("source").alias("direct_source"))
    direct = direct.join(source, [*turn, "direct"]).withColumnRenamed("target_turn_id", "turn_id")
    cluster = voted(evidence, ["session_id", "target_speaker_id"]).select("session_id", F.col("target_speaker_id").alias("speaker_id"), F.col("person").alias("spread"), F.col("purity").alias("spread_purity"))
    rows = turns.join(direct, ["session_id", "turn_id"], "left").join(cluster, ["session_id", "speaker_id"], "left")
    chair = contains_any(F.col("text"))
    who = F.struct(*[F.lit(x).alias(f) for x, f in zip(CHAIR, _PERSON, strict=True) if f in evidence.schema["person"].dataType.names])
    return rows.select(
        "session_id",
        "turn_id",
        "speaker_id",
        F.when(chair, who).otherwise(F.coalesce("direct", "spread")).alias("current_person"),
        F.when(chair, CHAIR_SOURCE).when(F.col("direct").isNotNull(), F.col("direct_source")).when(F.col("spread").isNotNull(), SPREAD_SOURCE).otherwise("unknown").alias("source"),
        F.when(chair, 1.0).otherwise(F.coalesce("direct_purity", "spread_purity")).alias("purity"),
    )


class MajorityTie(ValueError):
    """Two persons have exactly equal evidence for one speaker."""


def cluster_majorities(evidence: DataFrame, turns: DataFrame) -> DataFrame:
    """Per speaker: the person with the longest evidence, its share of all evidence and of all speech.

    evidence: session_id, speaker_id, person_key, seconds. A tie at the top is an error.
    """
    total = turns.groupBy("session_id", "speaker_id").agg(F.sum(F.col("end_seconds") - F.col("start_seconds")).alias("speech_seconds"))
    sums = evidence.groupBy("session_id", "speaker_id", "person_key").agg(F.sum("seconds").alias("seconds"))
    by = Window.partitionBy("session_id", "speaker_id")
    ranked = sums.withColumn("evidence_seconds", F.sum("seconds").over(by)).filter("evidence_seconds > 0").withColumn("r", F.rank().over(by.orderBy(F.desc("seconds"))))
    top = ranked.filter("r = 1")
    tied = top.groupBy("session_id", "speaker_id").count().filter("count > 1").limit(1).collect()
    if tied:
        raise MajorityTie(f"speaker {tied[0]['speaker_id']} of session {tied[0]['session_id']}")
    out = total.join(top, ["session_id", "speaker_id"], "left")
    return out.select("session_id", "speaker_id", "speech_seconds", "person_key", (F.col("seconds") / F.col("evidence_seconds")).alias("evidence_purity"), F.when(F.col("speech_seconds") > 0, F.col("seconds") / F.col("speech_seconds")).alias("absolute_purity"))
