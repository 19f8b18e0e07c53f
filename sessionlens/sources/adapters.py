"""Session relations derived from the general tables, for queries and tests.

Times are kept in whole milliseconds until the end, so that seconds are the same double in
every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRANSCRIPT, DIARIZATION, VOICE = ("view", "click"), ("purchase", "signup"), ("error",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """Intervals of three sessions and five speakers each, from ``events``."""
    events = table(spark, sf_dir, "events")
    if kinds:
        events = events.filter(F.col("event_type").isin(*kinds))
    start = F.floor(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))") / 1000)
    length = F.round(F.col("value") * 100).cast("long") * 200
    speaker = F.concat(F.lit("SPEAKER_"), F.lpad(((F.col("user_id") / 3).cast("long") % 5).cast("string"), 2, "0"))
    rows = events.select((F.col("event_id") + 1).alias("segment_id"), (F.col("user_id") % 3).alias("session_id"), speaker.alias("speaker_id"), start.alias("ms"), (start + length).alias("end_ms"), "event_type", "value")
    return rows.select("session_id", "segment_id", "speaker_id", (F.col("ms").cast("double") / 1000).alias("start_seconds"), (F.col("end_ms").cast("double") / 1000).alias("end_seconds"), "event_type", "value")


#: The same in SQL, as a common table expression named seg.
SEGMENTS_SQL = """
    seg0 AS (SELECT event_id + 1 AS segment_id, user_id % 3 AS session_id, 'SPEAKER_' || lpad(CAST((user_id // 3) % 5 AS VARCHAR), 2, '0') AS speaker_id,
      (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000 AS ms, CAST(round(value * 100) AS BIGINT) * 200 AS len, event_type, value FROM events),
    seg AS (SELECT session_id, segment_id, speaker_id, CAST(ms AS DOUBLE) / 1000 AS start_seconds, CAST(ms + len AS DOUBLE) / 1000 AS end_seconds, event_type, value FROM seg0),
    tr AS (SELECT *, -value / 500 AS avg_logprob, value / 500 AS no_speech_prob FROM seg WHERE event_type IN ('view', 'click')),
    di AS (SELECT * FROM seg WHERE event_type IN ('purchase', 'signup')),
    va AS (SELECT * FROM seg WHERE event_type = 'error')
"""


def transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir, TRANSCRIPT).withColumns({"avg_logprob": -F.col("value") / 500, "no_speech_prob": F.col("value") / 500})


def diarization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir, DIARIZATION)


def voice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir, VOICE)
