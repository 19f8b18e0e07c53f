"""The relational model: dimensions, numbers, bridges, and the checks before a load."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_name, title_of
from ..sources.schemas import REFERENCES, TABLES, UNIQUE
from .identity import cluster_majorities


class LoadError(ValueError):
    """A table breaks the model."""


class DuplicateRows(LoadError):
    pass


class MissingReference(LoadError):
    pass


class MisalignedTurns(LoadError):
    pass


class ExternalIdConflict(LoadError):
    pass


class InvalidArtifact(LoadError):
    pass


class InvalidId(LoadError):
    pass


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that stand more than once, and how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def missing(df: DataFrame, other: DataFrame, columns: tuple[str, ...], others: tuple[str, ...]) -> DataFrame:
    """Distinct references that the other table lacks, in order."""
    have = other.select(*[F.col(o).alias(c) for c, o in zip(columns, others, strict=True)])
    asked = df.select(*columns).distinct()
    for c in columns:
        asked = asked.filter(F.col(c).isNotNull())
    return asked.join(have, list(columns), "left_anti").orderBy(*columns)


def validate(tables: dict[str, DataFrame]) -> None:
    """Raise the first violation of uniqueness or reference; up to ten rows are named."""
    for name, keys in UNIQUE.items():
        if name in tables and (bad := duplicates(tables[name], *keys).orderBy(*keys).limit(10).collect()):
            raise DuplicateRows(f"{name}: {[tuple(r)[:-1] for r in bad]}")
    for name, columns, other, others in REFERENCES:
        if name in tables and other in tables and (bad := missing(tables[name], tables[other], columns, others).limit(10).collect()):
            raise MissingReference(f"{name} -> {other}: {[tuple(r) for r in bad]}")


def validate_ids(df: DataFrame, column: str) -> None:
    """Ids count from 1; nulls and smaller ones are errors."""
    if n := df.filter(F.col(column).isNull() | (F.col(column) < 1)).limit(10).count():
        raise InvalidId(f"{column}: {n} invalid ids or more")


def validate_vectors(df: DataFrame, vector: str, dimension: int) -> None:
    """All vectors have the dimension and finite components."""
    bad = F.col(vector).isNull() | (F.size(vector) != dimension) | F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    if n := df.filter(bad).limit(10).count():
        raise InvalidArtifact(f"{vector}: {n} invalid vectors or more")


def conformed(df: DataFrame, name: str) -> DataFrame:
    """The columns of a table of the model in their order and types; missing ones are null."""
    out = []
    for part in TABLES[name].split(", "):
        column, kind = part.split(" ", 1)
        out.append((F.col(column) if column in df.columns else F.lit(None)).cast(kind).alias(column))
    return df.select(*out)


def numbered(df: DataFrame, name: str, order: list[str], keys: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """Numbers from 1 in a total order inside each key; the same in every run."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


def persons(identities: DataFrame) -> DataFrame:
    """One row a (normalized name, kind): the first name and role, and the first identifier that isn't null.

    identities: ord, id, name, role, kind. Two different identifiers are an error.
    """
    rows = identities.withColumn("normalized_name", normalize_name(F.col("name")))
    found = rows.groupBy("normalized_name", "kind").agg(
        F.min_by(F.struct("name", "role"), "ord").alias("first"),
        F.min_by("id", F.when(F.col("id").isNotNull(), F.col("ord"))).alias("external_id"),
        F.countDistinct("id").alias("ids"),
        F.min("ord").alias("ord"),
    )
    if bad := found.filter("ids > 1").limit(10).collect():
        raise ExternalIdConflict(str([(r["normalized_name"], r["kind"]) for r in bad]))
    return found.select("normalized_name", "kind", "first.name", "external_id", "first.role", "ord")


def upserted(old: DataFrame, new: DataFrame) -> DataFrame:
    """Known persons with what is new added: old values win, nulls are filled."""
    a, b = old.alias("a"), new.alias("b")
    joined = a.join(b, ["normalized_name", "kind"], "full")
    return joined.select("normalized_name", "kind", *[F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in ("name", "external_id", "role")])


def _found(key: Column, asked: Column, what: str, shown: Column) -> Column:
    """The key; an error that names what was asked for, if that is not null and has none."""
    message = F.concat(F.lit(f"{what} not loaded: "), shown.cast("string"))
    return F.when(asked & key.isNull(), F.raise_error(message).cast("long")).otherwise(key)


def with_clusters(rows: DataFrame, clusters: DataFrame, label: str = "speaker_id") -> DataFrame:
    """Add ``cluster_id``, the key of a speaker label in its session. A label without one is an error when rows are read; none has none.

    clusters: session_id, label, cluster_id.
    """
    keys = clusters.select("session_id", F.col("label").alias(label), F.col("cluster_id").cast("long").alias("_key"))
    joined = rows.join(keys, ["session_id", label], "left")
    return joined.select(*[F.col(c) for c in rows.columns], _found(F.col("_key"), F.col(label).isNotNull(), "speaker cluster", F.col(label)).alias("cluster_id"))


def with_persons(rows: DataFrame, people: DataFrame, person: str = "current_person") -> DataFrame:
    """Add ``person_id``, the key of a person by its normalised name and kind. A person without one is an error when rows are read.

    rows: a struct of name and kind, or null for nobody. people: normalized_name, kind, person_id.
    """
    keys = people.select(F.col("normalized_name").alias("_name"), F.col("kind").alias("_kind"), F.col("person_id").cast("long").alias("_key"))
    asked = rows.withColumns({"_name": normalize_name(F.col(f"{person}.name")), "_kind": F.col(f"{person}.kind")})
    joined = asked.join(keys, ["_name", "_kind"], "left")
    return joined.select(*[F.col(c) for c in rows.columns], _found(F.col("_key"), F.col(person).isNotNull(), "person", F.col("_name")).alias("person_id"))


def evidence_json(evidence: Column) -> Column:
    """The JSON column of a turn's evidence: a list of objects with all fields, nulls too; [] without any."""
    return F.coalesce(F.to_json(evidence, {"ignoreNullFields": "false"}), F.lit("[]"))


def bridges(turns: DataFrame, column: str) -> DataFrame:
    """One row a turn and id of one of its id arrays."""
    return turns.select("session_id", "turn_id", F.explode(column).alias("segment_id")).distinct()


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name and n, by one union of aggregates."""
    out = None
    for name, df in tables.items():
        rows = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = rows if out is None else out.unionByName(rows)
    return out


def clusters(turns: DataFrame, labels: DataFrame) -> DataFrame:
    """Speech of each speaker label; 0 for labels without turns."""
    spoken = turns.groupBy("session_id", F.col("speaker_id").alias("label")).agg(F.sum(F.col("end_seconds") - F.col("start_seconds")).alias("total_detected_speech"))
    return labels.select("session_id", "label").distinct().join(spoken, ["session_id", "label"], "left").fillna(0.0, ["total_detected_speech"])


def session_row(runs: DataFrame) -> DataFrame:
    """Session rows from file stems: slug, title."""
    return runs.withColumn("title", title_of(F.col("slug")))


# Sources that older documents use without evidence of the turn itself.
OLD_SOURCES = ("inferred_from_next_speaker", "inferred_from_previous_speaker")


def remapped_source(source: Column, evidence: Column) -> Column:
    """The source of a turn's speaker; an old one without evidence is a speaker's majority."""
    old = source.isin(*OLD_SOURCES)
    return F.when(old & (F.coalesce(F.size(evidence), F.lit(0)) <= 0), "propagated_from_speaker_cluster").otherwise(source)


def run_id(runs: DataFrame, session: int, stage: str) -> int:
    """The id of the run of a stage of a session; an error if there is none."""
    found = runs.filter((F.col("session_id") == session) & (F.col("stage") == stage)).select("run_id").limit(1).collect()
    if not found:
        raise MissingReference(f"pipeline_run: session {session}, stage {stage!r}")
    return found[0]["run_id"]


def config_json(config) -> str:
    """The JSON column of a stage's configuration."""
    return json.dumps(asdict(config), ensure_ascii=False)


def cluster_rows(labels: DataFrame, turns: DataFrame, evidence: DataFrame, people: DataFrame) -> DataFrame:
    """Speaker clusters as they are loaded: number in order of labels, speech, the person with the longest evidence, both purities.

    Only evidence that is eligible, and whose target is a turn with a speaker, counts; each piece
    weighs as much as its turn is long. evidence: session_id, target_turn_id,
    eligible_for_cluster_majority, person. A person that isn't loaded and a tie are errors.
    """
    spoken = turns.filter("speaker_id is not null")
    targets = spoken.select("session_id", F.col("turn_id").alias("target_turn_id"), "speaker_id", (F.col("end_seconds") - F.col("start_seconds")).alias("seconds"))
    able = evidence.filter("eligible_for_cluster_majority").join(targets, ["session_id", "target_turn_id"])
    keyed = with_persons(able, people, "person").select("session_id", "speaker_id", F.col("person_id").alias("person_key"), "seconds")
    won = cluster_majorities(keyed, spoken).select("session_id", F.col("speaker_id").alias("label"), F.col("person_key").alias("majority_person_id"), "evidence_purity", "absolute_purity")
    rows = clusters(spoken, labels).join(won, ["session_id", "label"], "left")
    return conformed(numbered(rows, "cluster_id", ["label"]), "speaker_cluster")


def embedding_rows(turn_vectors: DataFrame, chunk_vectors: DataFrame, runs: DataFrame, model: str, normalized: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of embedding, turn_embedding and semantic_chunk: ids count the turns' vectors first, then the chunks'.

    turn_vectors: session_id, turn_id, embedding. chunk_vectors: session_id, turn_id, chunk_index,
    start_sentence_index, end_sentence_index, text, embedding. runs: session_id, run_id. Vectors of
    different lengths in a session are an error when rows are read.
    """
    if not model:
        raise InvalidArtifact("the metadata name no model")
    marks = ("chunk_index", "start_sentence_index", "end_sentence_index")
    first = turn_vectors.select("session_id", F.lit(0).alias("_part"), "turn_id", *[F.lit(None).cast("int").alias(c) for c in marks], F.lit(None).cast("string").alias("text"), "embedding")
    rows = first.unionByName(chunk_vectors.select("session_id", F.lit(1).alias("_part"), "turn_id", *marks, "text", "embedding"))
    sizes = Window.partitionBy("session_id")
    size = F.size("embedding")
    equal = F.min(size).over(sizes) == F.max(size).over(sizes)
    rows = numbered(rows, "embedding_id", ["_part", "turn_id", "chunk_index"]).withColumn("dimension", F.when(equal, size).otherwise(F.raise_error(F.lit("vectors of different dimensions")).cast("int")))
    rows = rows.join(runs.select("session_id", "run_id"), "session_id")
    base = rows.withColumns({"model_name": F.lit(model), "vector": F.col("embedding"), "dtype": F.lit("float32"), "normalized": F.lit(normalized)})
    return conformed(base, "embedding"), conformed(rows.filter("_part = 0"), "turn_embedding"), conformed(rows.filter("_part = 1"), "semantic_chunk")
