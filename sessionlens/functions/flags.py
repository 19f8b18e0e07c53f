"""Quality flags of segments and turns: named bits of one 64 bit number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: name: (bit, what it says), in the order of the bits.
FLAGS = {
    "IMPOSSIBLE_SPEECH_RATE": (0, "more words or characters a second than anyone speaks"),
    "INFORMATION_RATE_TOO_HIGH": (1, "too many bytes of text a second"),
    "NEEDS_REVIEW": (2, "to be looked at"),
    "GIBBERISH": (3, "text without meaning"),
    "NON_FRENCH": (4, "text in another language"),
    "MOSTLY_SILENCE_WITH_SHORT_EVENT": (5, "quiet but for one short event"),
    "ADJACENT_INFORMATION_RATE_ANOMALY": (6, "a neighbour has an anomaly of rate or length"),
    "OUTSIDE_VAD": (10, "no voice activity at all"),
    "PARTIAL_VAD_OVERLAP": (11, "voice activity for a part of it only"),
    "DISCONTIGUOUS_VAD_COVERAGE": (12, "a long gap in voice activity"),
    "LONG_WHISPER_SEGMENT_LOW_VAD_COVERAGE": (13, "long, with little voice activity"),
    "LOW_WHISPER_CONFIDENCE": (20, "low mean log probability"),
    "HIGH_NO_SPEECH_PROB": (21, "probably no speech"),
    "HIGH_COMPRESSION_RATIO": (22, "repetitive text"),
    "LONG_DURATION_SHORT_TEXT": (23, "long, with little text"),
    "DIARIZATION_OVERLAP": (30, "several speakers at once"),
    "MULTI_SPEAKER_CANDIDATE": (31, "overlaps segments of several speakers"),
    "SPEAKER_CHANGE_NEARBY": (32, "near a change of speaker"),
    "TIE_BREAK_SPEAKER": (33, "speaker chosen among equals"),
    "ORPHAN_TRANSCRIPT": (40, "text without a speaker segment"),
    "ORPHAN_DIARIZATION": (41, "speaker segment without text"),
    "UNSAFE_FOR_SPEAKER_CENTROID": (42, "not to be used for voice prints"),
}
BIT = {name: 1 << bit for name, (bit, _) in FLAGS.items()}


def mask(*names: str) -> int:
    """The named bits together."""
    out = 0
    for name in names:
        out |= BIT[name]
    return out


def flag_if(condition: Column, name: str) -> Column:
    """The bit where the condition holds; 0 where it doesn't or is null."""
    return F.when(condition, F.lit(BIT[name]).cast("long")).otherwise(F.lit(0).cast("long"))


def any_of(*flags: Column) -> Column:
    """Bitwise or."""
    out = flags[0]
    for f in flags[1:]:
        out = out.bitwiseOR(f)
    return out


def has_flag(flags: Column, name: str) -> Column:
    """Whether a flag is set. A name that doesn't exist is never set."""
    return flags.bitwiseAND(F.lit(BIT.get(name, 0)).cast("long")) != 0


def flag_names(flags: Column) -> Column:
    """Names of the set bits, in the order of the bits."""
    known = F.array(*[F.struct(F.lit(BIT[n]).cast("long").alias("bit"), F.lit(n).alias("name")) for n in FLAGS])
    return F.transform(F.filter(known, lambda x: flags.bitwiseAND(x["bit"]) != 0), lambda x: x["name"])


def flag_table(spark: SparkSession) -> DataFrame:
    """One row a flag: bit, value, name and description."""
    return spark.createDataFrame([(b, 1 << b, n, d) for n, (b, d) in FLAGS.items()], "bit int, value long, name string, description string")


def register_sql(spark: SparkSession) -> None:
    """SQL functions that are expressions, so that queries with them stay in generated code."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION dot_product(a ARRAY<FLOAT>, b ARRAY<FLOAT>) RETURNS DOUBLE RETURN aggregate(zip_with(a, b, (x, y) -> double(x) * double(y)), 0D, (s, x) -> s + x)")
    pairs = ", ".join(f"named_struct('bit', {BIT[n]}L, 'name', '{n}')" for n in FLAGS)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION flag_names(flags BIGINT) RETURNS ARRAY<STRING> RETURN transform(filter(array({pairs}), x -> (flags & x.bit) <> 0), x -> x.name)")
    cases = " ".join(f"WHEN '{n}' THEN {BIT[n]}L" for n in FLAGS)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION has_flag_name(flags BIGINT, name STRING) RETURNS INT RETURN if((flags & (CASE name {cases} ELSE 0L END)) <> 0, 1, 0)")
