"""Segments as a stream: turns that close when the speaker changes or falls silent.

The batch operators define what a turn is. The stream keeps, for each session, the open turn
in state and emits it once a later segment closes it, or when event time has passed its end
by the silence limit. Segments are put into order inside a trigger; those behind the watermark
are dropped, as in every Structured Streaming aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SEGMENT = "session_id long, segment_id long, speaker_id string, start_seconds double, end_seconds double, text string"
TURN = "session_id long, speaker_id string, start_seconds double, end_seconds double, segments long, text string"
_STATE = "speaker_id string, start_seconds double, end_seconds double, segments long, text string"


def arriving(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """JSON segments of a folder as they arrive; ``ts`` is a millisecond after their start, as a first watermark of 0 drops what is not later."""
    rows = spark.readStream.schema(SEGMENT).option("maxFilesPerTrigger", files_per_trigger).json(folder)
    return rows.withColumn("ts", F.timestamp_millis((F.col("start_seconds") * 1000).cast("long") + 1))


def closing_turns(segments: DataFrame, max_silence: float = 5.0, lateness: str = "10 minutes") -> DataFrame:
    """Closed turns of a stream of segments with a ``ts`` column."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        turn = list(state.get) if state.exists else None
        closed = []
        if state.hasTimedOut:
            state.remove()
            if turn:
                yield pd.DataFrame([(key[0], *turn)], columns=["session_id", "speaker_id", "start_seconds", "end_seconds", "segments", "text"])
            return
        rows = pd.concat(list(batches)).sort_values(["start_seconds", "segment_id"], kind="stable")
        for x in rows.itertuples(index=False):
            same = turn is not None and turn[0] == x.speaker_id and x.start_seconds - turn[2] <= max_silence
            if not same:
                if turn is not None:
                    closed.append((key[0], *turn))
                turn = [x.speaker_id, x.start_seconds, x.end_seconds, 1, x.text or ""]
            else:
                turn = [turn[0], min(turn[1], x.start_seconds), max(turn[2], x.end_seconds), turn[3] + 1, f"{turn[4]} {x.text or ''}".strip()]
        state.update(tuple(turn))
        state.setTimeoutTimestamp(max(int((turn[2] + max_silence) * 1000) + 1, state.getCurrentWatermarkMs() + 1))
        if closed:
            yield pd.DataFrame(closed, columns=["session_id", "speaker_id", "start_seconds", "end_seconds", "segments", "text"])

    rows = segments.withWatermark("ts", lateness)
    return rows.groupBy("session_id").applyInPandasWithState(step, TURN, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def speaker_sessions(segments: DataFrame, max_silence: float = 5.0, lateness: str = "10 minutes") -> DataFrame:
    """Session windows of each speaker: equal to turns where nobody interrupts."""
    rows = segments.withWatermark("ts", lateness)
    window = F.session_window("ts", f"{int(max_silence * 1000)} milliseconds")
    return rows.groupBy("session_id", "speaker_id", window).agg(F.count("*").alias("segments"), F.min("start_seconds").alias("start_seconds"), F.max("end_seconds").alias("end_seconds"))


def speech_per_minute(segments: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Seconds of speech that begin in each minute."""
    rows = segments.withWatermark("ts", lateness)
    return rows.groupBy("session_id", F.window("ts", "1 minute")).agg(F.sum(F.col("end_seconds") - F.col("start_seconds")).alias("speech_seconds"))


def newly_arrived(spark: SparkSession, folder: str, checkpoint: str, target: str, max_silence: float = 5.0):
    """Process what has arrived since the last call and stop; the query."""
    turns = closing_turns(arriving(spark, folder), max_silence)
    return turns.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(target)
