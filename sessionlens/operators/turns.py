"""Turns: runs of one speaker whose segments follow each other with short silences only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import TICKS
from ..functions.text import strip
from .alignment import AlignmentConfig, elected
from .intervals import KEYS, union_seconds

MAX_SILENCE = 5.0


def turn_numbers(rows: DataFrame, order: tuple[str, ...], speaker: str = "speaker_id", start: str = "start_seconds", end: str = "end_seconds", max_silence: float = MAX_SILENCE, strict: bool = False) -> DataFrame:
    """Add ``turn_id``, from 1 for each session, over rows in the given order.

    A row begins a turn if its speaker is another or unknown, or if it starts more
    than ``max_silence`` after the latest end so far (``strict``: that much or more). The
    latest end may be taken over the speaker's whole run: a row after a pause ends later.
    """
    by = Window.partitionBy(*KEYS).orderBy(*order)
    change = F.when(F.col(speaker) == F.lag(speaker).over(by), 0).otherwise(1)
    runs = rows.withColumn("_run", change)
    runs = runs.withColumn("_run", F.sum("_run").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(*KEYS, "_run").orderBy(*order)
    latest = F.max(end).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    silence = F.col(start) - latest
    pause = silence >= max_silence if strict else silence > max_silence
    fresh = runs.withColumn("_new", F.when(latest.isNull() | pause, 1).otherwise(0))
    return fresh.withColumn("turn_id", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("_run", "_new")


def consolidated(matches: DataFrame, transcript: DataFrame, diarization: DataFrame, max_silence: float = MAX_SILENCE) -> DataFrame:
    """Turns from elected segments. Transcript segments without a speaker segment are left out.

    A segment's time is that of its matched speaker segments, and its flags are those of its match,
    its text and its speaker segments. Texts are joined in order, the confidence is weighted by the
    winner's overlap (a null one counts as 0), and the evidence ratio is the union of the winner's
    own speaker segments over the turn's length.
    """
    used = matches.filter(F.size("diarization_segment_ids") > 0)
    links = used.select("session_id", "transcript_segment_id", F.posexplode("diarization_segment_ids").alias("pos", "segment_id"))
    marks = F.col("flags") if "flags" in diarization.columns else F.lit(0).cast("long")
    spans = links.join(diarization.select("session_id", "segment_id", "speaker_id", "start_seconds", "end_seconds", marks.alias("segment_flags")), ["session_id", "segment_id"])
    each = F.struct("pos", "segment_id", "speaker_id", "start_seconds", "end_seconds")
    times = spans.groupBy("session_id", "transcript_segment_id").agg(F.min("start_seconds").alias("start_seconds"), F.max("end_seconds").alias("end_seconds"), F.bit_or("segment_flags").alias("segment_flags"), F.collect_list(each).alias("spans"))
    rows, turns = _gathered(used.join(times, ["session_id", "transcript_segment_id"]), transcript, max_silence)
    inside = rows.select("session_id", "turn_id", "ord", "transcript_segment_id", "probable_speaker_id", F.inline("spans"))
    own = F.max(F.col("speaker_id") == F.col("probable_speaker_id")).alias("own")
    once = inside.groupBy("session_id", "turn_id", "segment_id").agg(F.min(F.struct("ord", "transcript_segment_id", "pos")).alias("seen"), own, F.first("start_seconds").alias("start_seconds"), F.first("end_seconds").alias("end_seconds"))
    ids = once.groupBy("session_id", "turn_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seen", "segment_id"))), lambda x: x["segment_id"]).alias("diarization_segment_ids"))
    covered = union_seconds(once.filter("own"), ("session_id", "turn_id"))
    return _finished(turns.join(ids, ["session_id", "turn_id"]).join(covered, ["session_id", "turn_id"], "left"), "diarization_segment_ids")


def aligned(transcript: DataFrame, diarization: DataFrame, config: AlignmentConfig = AlignmentConfig(), max_silence: float = MAX_SILENCE) -> DataFrame:
    """The turns of ``consolidated`` for the elected speakers, without the lists of speaker segments.

    No row is made for a pair of segments. The winner's segments that meet a text segment cover what
    the winner covers from the first start to the last end of them, so that a running total of covered
    time at both gives their union.
    """
    marks = F.col("flags") if "flags" in diarization.columns else F.lit(0).cast("long")
    spoken = diarization.select("session_id", "segment_id", "speaker_id", "start_seconds", "end_seconds", marks.alias("flags"))
    matches = elected(transcript, _covered(spoken), config, False).filter(F.size("spans") > 0)
    own = F.get(F.filter("spans", lambda x: x["speaker_id"].eqNullSafe(F.col("probable_speaker_id"))), F.lit(0))
    of = lambda field: F.transform("spans", lambda x: x[field])
    flags = F.aggregate(of("segment_flags"), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    times = {"start_seconds": F.array_min(of("from_seconds")), "end_seconds": F.array_max(of("to_seconds")), "segment_flags": flags, "covered_from": own["covered_from"], "covered_to": own["covered_to"]}
    rows, turns = _gathered(matches.withColumns(times), transcript, max_silence)
    before = F.max("covered_to").over(Window.partitionBy("session_id", "turn_id").orderBy("covered_from", "covered_to").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0).cast("long"), F.col("covered_to") - F.greatest("covered_from", before))
    covered = rows.filter("probable_speaker_id is not null").select("session_id", "turn_id", fresh.alias("_t")).groupBy("session_id", "turn_id").agg((F.sum("_t") / TICKS).alias("union_seconds"))
    return _finished(turns.join(covered, ["session_id", "turn_id"], "left"))


def _covered(df: DataFrame) -> DataFrame:
    """Segments with the time that their speaker's segments cover until their start and until their end, in ticks."""
    by = Window.partitionBy(*KEYS, "speaker_id").orderBy("_a", "_b", "segment_id")
    real = df.filter("end_seconds > start_seconds").withColumns({f"_{n}": F.round(F.col(c) * TICKS).cast("long") for n, c in (("a", "start_seconds"), ("b", "end_seconds"))})
    rows = real.withColumn("_top", F.max("_b").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    none = F.lit(0).cast("long")
    rows = rows.withColumn("_new", F.greatest(none, F.col("_b") - F.greatest("_a", "_top")))
    rows = rows.withColumn("_sum", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    beyond = lambda c: F.greatest(none, F.coalesce(F.col("_top") - F.col(c), none))
    return rows.withColumns({"covered_from": F.col("_sum") - F.col("_new") - beyond("_a"), "covered_to": F.col("_sum") - beyond("_b")}).drop("_a", "_b", "_top", "_new", "_sum")


def _gathered(used: DataFrame, transcript: DataFrame, max_silence: float) -> tuple[DataFrame, DataFrame]:
    """Matches with the number of their turn, and what is gathered from them for each turn."""
    words = transcript.select("session_id", F.col("segment_id").alias("transcript_segment_id"), F.col("start_seconds").alias("ord"), F.col("text"), F.col("flags").alias("text_flags"))
    rows = used.join(words, ["session_id", "transcript_segment_id"])
    rows = turn_numbers(rows, ("ord", "transcript_segment_id"), "probable_speaker_id", max_silence=max_silence)
    weight = F.col("winning_overlap_seconds")
    parts = F.array_sort(F.collect_list(F.struct("ord", "transcript_segment_id", "text")))
    turns = rows.groupBy("session_id", "turn_id").agg(
        F.first("probable_speaker_id", True).alias("speaker_id"),
        F.min("start_seconds").alias("start_seconds"),
        F.max("end_seconds").alias("end_seconds"),
        parts.alias("parts"),
        F.bit_or(F.col("flags").bitwiseOR(F.col("text_flags")).bitwiseOR(F.col("segment_flags"))).alias("flags"),
        F.sum(F.coalesce("speaker_confidence", F.lit(0.0)) * weight).alias("_c"),
        F.sum(weight).alias("_w"),
    )
    return rows, turns


def _finished(out: DataFrame, *more: str) -> DataFrame:
    length = F.col("end_seconds") - F.col("start_seconds")
    return out.select(
        "session_id",
        "turn_id",
        "speaker_id",
        "start_seconds",
        "end_seconds",
        strip(F.array_join(F.transform("parts", lambda x: x["text"]), " ")).alias("text"),
        F.when(F.col("_w") > 0, F.col("_c") / F.col("_w")).otherwise(0.0).alias("speaker_confidence"),
        F.when(length > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce("union_seconds", F.lit(0.0)) / length))).otherwise(0.0).alias("speaker_evidence_ratio"),
        F.transform("parts", lambda x: x["transcript_segment_id"]).alias("transcript_segment_ids"),
        *more,
        "flags",
    )
