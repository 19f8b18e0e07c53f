"""Queries of whole stages: decoder output, segment audit, anomalies, rows as they are loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import audit, decoding, intervals, legacy, loading, parsed
from ..sources.adapters import SEGMENTS_SQL, diarization, segments, table, transcript, voice
from .interval_queries import _CLIP, _FRAMES, _REGIONS, frames
from .registry import query

# Words of conversations as decoder output: word k of a turn lasts a second from k on; every seventh has no end.
_WORDS_SQL = "ws AS (SELECT conv_id, turn, string_split(text, ' ') AS ws FROM conversations WHERE text IS NOT NULL), wk AS (SELECT conv_id, turn, unnest(ws) AS word, unnest(range(len(ws))) AS k FROM ws), wn AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, k) - 1 AS token_id FROM wk WHERE k % 7 <> 6)"


def _decoder(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").filter("text is not null")
    words = F.transform(F.split("text", " "), lambda w, k: F.struct(k.cast("double").alias("start"), F.when(k % 7 != 6, k + 1.0).alias("end"), w.alias("word")))
    return turns.select(F.col("conv_id"), F.col("turn").alias("ord"), "text", words.alias("words"), F.col("turn").alias("said"))


@query("decoded_tokens", f"WITH {_WORDS_SQL} SELECT conv_id, CAST(token_id AS BIGINT) AS token_id, CAST(k AS DOUBLE) AS start_seconds, CAST(k + 1 AS DOUBLE) AS end_seconds, word AS raw_token FROM wn")
def decoded_tokens(spark: SparkSession, d: str) -> DataFrame:
    tokens = decoding.decoded(_decoder(spark, d), ("conv_id",))[1]
    return tokens.withColumn("token_id", F.col("token_id").cast("long"))


@query(
    "decoded_segments",
    f"""WITH {_WORDS_SQL}, e AS (SELECT conv_id, turn, min(token_id) AS a, max(token_id) AS b FROM wn GROUP BY ALL)
    SELECT s.conv_id, s.turn AS said, CAST(row_number() OVER (PARTITION BY s.conv_id ORDER BY s.turn) AS INTEGER) AS segment_id, coalesce(CAST(a AS BIGINT), -1) AS start_token_id, coalesce(CAST(b AS BIGINT), -1) AS end_token_id, array_to_string(s.ws, ' ') AS raw_text FROM ws s LEFT JOIN e USING (conv_id, turn)""",
)
def decoded_segments(spark: SparkSession, d: str) -> DataFrame:
    rows = decoding.decoded(_decoder(spark, d), ("conv_id",))[0]
    return rows.select("conv_id", "said", "segment_id", *[F.coalesce(F.col(c).cast("long"), F.lit(-1).cast("long")).alias(c) for c in ("start_token_id", "end_token_id")], "raw_text")


@query("token_text", f"WITH {_WORDS_SQL} SELECT conv_id, string_agg(word, '' ORDER BY token_id) AS text FROM wn GROUP BY conv_id")
def token_text(spark: SparkSession, d: str) -> DataFrame:
    return decoding.token_text(decoding.decoded(_decoder(spark, d), ("conv_id",))[1], "conv_id")


@query(
    "token_anchors",
    f"""WITH {SEGMENTS_SQL}, t AS (SELECT session_id, segment_id AS token_id, (start_seconds + coalesce(lead(end_seconds) OVER (PARTITION BY session_id ORDER BY segment_id), end_seconds)) / 2 AS anchor FROM tr),
    m AS (SELECT t.session_id, token_id, arg_min(d.segment_id, struct_pack(a := d.start_seconds, b := d.segment_id)) AS segment_id FROM t JOIN di d ON d.session_id = t.session_id AND anchor BETWEEN d.start_seconds AND d.end_seconds GROUP BY ALL)
    SELECT t.session_id, token_id, round(anchor, 4) AS anchor_seconds, coalesce(m.segment_id, -1) AS segment_id FROM t LEFT JOIN m USING (session_id, token_id)""",
)
def token_anchors(spark: SparkSession, d: str) -> DataFrame:
    tokens = transcript(spark, d).select("session_id", F.col("segment_id").alias("token_id"), "start_seconds", "end_seconds")
    rows = decoding.by_anchor(tokens, diarization(spark, d))
    return rows.select("session_id", "token_id", F.round("anchor_seconds", 4).alias("anchor_seconds"), F.coalesce("segment_id", F.lit(-1).cast("long")).alias("segment_id"))


@query("parallel_arrays", "SELECT conv_id, turn, CAST(list_sum(list_transform(string_split(text, ' '), lambda w, k: len(w) * k)) AS BIGINT) AS weight FROM conversations WHERE text IS NOT NULL")
def parallel_arrays(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").filter("text is not null").withColumn("w", F.split("text", " ")).withColumn("k", F.sequence(F.lit(1), F.size("w")))
    return turns.select("conv_id", "turn", F.aggregate(decoding.zipped(F.col("w"), F.col("k")), F.lit(0).cast("long"), lambda s, p: s + F.length(p["w"]) * p["k"]).alias("weight"))


@query(
    "segment_audit",
    f"""WITH {SEGMENTS_SQL}, {_CLIP}, {_FRAMES}, {_REGIONS}, x AS (SELECT *, segment_id % 7 AS k, end_seconds - start_seconds AS len FROM tr),
    fs AS (SELECT t.session_id, t.segment_id, count(c) AS frame_count, avg(db) AS db_mean, quantile_cont(db, 0.1) AS db_p10, quantile_cont(db, 0.5) AS db_p50, quantile_cont(db, 0.9) AS db_p90, quantile_cont(db - med, 0.95) AS db_delta_p95 FROM tr t LEFT JOIN fd ON t.session_id = fd.session_id AND c BETWEEN t.start_seconds AND t.end_seconds GROUP BY ALL),
    cr AS (SELECT t.session_id, t.segment_id, sum(least(t.end_seconds, r.end_seconds) - greatest(t.start_seconds, r.start_seconds)) AS crowd, count(*) AS regions FROM tr t JOIN rg r ON t.session_id = r.session_id AND t.start_seconds < r.end_seconds AND r.start_seconds < t.end_seconds WHERE t.end_seconds > t.start_seconds GROUP BY ALL),
    a AS (SELECT x.*, CASE WHEN len > 0 THEN least(1, coalesce(cov, 0) / len) ELSE 0 END AS coverage, coalesce(gap, 0) AS gap, coalesce(crowd, 0) AS crowd, coalesce(regions, 0) AS regions, fs.* EXCLUDE (session_id, segment_id) FROM x LEFT JOIN cg USING (session_id, segment_id) LEFT JOIN cr USING (session_id, segment_id) JOIN fs USING (session_id, segment_id)),
    f AS (SELECT *, (CASE WHEN avg_logprob <= -0.05 THEN 1 << 20 ELSE 0 END) + (CASE WHEN no_speech_prob >= 0.1 THEN 1 << 21 ELSE 0 END) + (CASE WHEN len > 0 AND len < 0.4 AND (k / len > 8 OR 3 * k / len > 45) THEN 1 ELSE 0 END)
      + (CASE WHEN len > 0 AND 3 * k / len > 60 THEN 2 ELSE 0 END) + (CASE WHEN len >= 8 AND (k < 4 OR 3 * k < 25) THEN 1 << 23 ELSE 0 END) + (CASE WHEN coverage = 0 THEN 1024 WHEN coverage < 0.8 THEN 2048 ELSE 0 END) + (CASE WHEN len >= 10 AND coverage < 0.6 THEN 8192 ELSE 0 END)
      + (CASE WHEN coverage > 0 AND gap >= 0.75 THEN 4096 ELSE 0 END) + (CASE WHEN len <= 3 AND frame_count > 0 AND db_p50 <= -55 AND db_delta_p95 >= 15 THEN 32 ELSE 0 END) + (CASE WHEN crowd > 0 THEN 1 << 30 ELSE 0 END) AS flags FROM a)
    SELECT session_id, segment_id, round(len, 4) AS duration_seconds, CAST(3 * k AS BIGINT) AS text_char_count, CAST(k AS BIGINT) AS text_word_count, CAST(3 * k AS BIGINT) AS text_byte_cout, round(coverage, 6) AS vad_coverage, round(crowd, 4) AS diarization_overlap_seconds,
      regions AS diarization_overlap_region_count, frame_count, round(db_mean, 10) AS db_mean, round(db_p10, 6) AS db_p10, round(db_p50, 6) AS db_p50, round(db_p90, 6) AS db_p90, round(db_delta_p95, 6) AS db_delta_p95, CAST(flags AS BIGINT) AS flags FROM f""",
)
def segment_audit(spark: SparkSession, d: str) -> DataFrame:
    said = transcript(spark, d).withColumns({"text": F.repeat(F.lit("mot "), (F.col("segment_id") % 7).cast("int")), "flags": F.lit(0).cast("long"), "compression_ratio": F.lit(None).cast("double")})
    config = audit.AuditConfig(min_logprob=-0.05, max_no_speech=0.1)
    rows = audit.audited(said, voice(spark, d), audit.rolling_median(frames(spark, d)), intervals.overlap_regions(diarization(spark, d)), config)
    rows = audit.sidecar(rows)
    exact = {"duration_seconds": 4, "vad_coverage": 6, "diarization_overlap_seconds": 4, "db_mean": 10, "db_p10": 6, "db_p50": 6, "db_p90": 6, "db_delta_p95": 6}
    rows = rows.withColumns({c: F.round(c, n) for c, n in exact.items()})
    return rows.select("session_id", "segment_id", "duration_seconds", "text_char_count", "text_word_count", "text_byte_cout", "vad_coverage", "diarization_overlap_seconds", "diarization_overlap_region_count", "frame_count", "db_mean", "db_p10", "db_p50", "db_p90", "db_delta_p95", "flags")


@query(
    "partial_overlap_spread",
    f"""WITH {SEGMENTS_SQL}, {_CLIP}, p AS (SELECT end_seconds - start_seconds AS x FROM tr t JOIN cg USING (session_id, segment_id) WHERE cov > 0 AND cov / (end_seconds - start_seconds) < 0.8)
    SELECT count(x) AS n, round(avg(x), 4) AS mean, round(quantile_cont(x, 0.5), 4) AS median, round(quantile_cont(x, 0.1), 4) AS p10, round(quantile_cont(x, 0.9), 4) AS p90, round(min(x), 4) AS min, round(max(x), 4) AS max, round(stddev_pop(x), 4) AS std FROM p""",
)
def partial_overlap_spread(spark: SparkSession, d: str) -> DataFrame:
    said = transcript(spark, d)
    seconds = F.col("end_seconds") - F.col("start_seconds")
    rows = audit.voice_coverage(said, voice(spark, d)).join(said, ["session_id", "segment_id"]).withColumn("seconds", seconds)
    flagged = rows.filter(audit.voice_flags(seconds).bitwiseAND(2048) != 0)
    found = legacy.spread(flagged, "seconds")
    return found.select("n", *[F.round(c, 4).alias(c) for c in found.columns[1:]])


@query(
    "logprob_changes",
    f"""WITH {SEGMENTS_SQL}, v AS (SELECT session_id, segment_id, (start_seconds + end_seconds) / 2 AS m, -avg_logprob AS b FROM tr), c AS (SELECT session_id, segment_id, (m + lead(m) OVER w) / 2 AS at_seconds, lead(b) OVER w - b AS change FROM v WINDOW w AS (PARTITION BY session_id ORDER BY segment_id))
    SELECT session_id, segment_id, round(at_seconds, 4) AS at_seconds, round(change, 6) AS change FROM c WHERE change IS NOT NULL ORDER BY round(abs(change), 6) DESC, session_id, segment_id LIMIT 20""",
)
def logprob_changes(spark: SparkSession, d: str) -> DataFrame:
    rows = legacy.changes(transcript(spark, d), -F.col("avg_logprob"))
    rows = rows.select("session_id", "segment_id", F.round("at_seconds", 4).alias("at_seconds"), F.round("change", 6).alias("change"))
    return rows.orderBy(F.desc(F.abs("change")), "session_id", "segment_id").limit(20)  # the report is a top-20


def _sounds(spark: SparkSession, d: str) -> DataFrame:
    """One frame an event, half a second long: db = -value / 5, flatness = value / 500."""
    order = Window.partitionBy("session_id").orderBy("start_seconds", "segment_id")
    return segments(spark, d).select("session_id", F.row_number().over(order).alias("frame_index"), "start_seconds", (F.col("start_seconds") + 0.5).alias("end_seconds"), (-F.col("value") / 5).alias("db"), (F.col("value") / 500).alias("spectral_flatness"))


_SOUNDS_SQL = "so AS (SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY start_seconds, segment_id) AS i, start_seconds AS a, start_seconds + 0.5 AS b, -value / 5 AS db, value / 500 AS x FROM seg)"
_SPIKES_SQL = f"""{_SOUNDS_SQL}, ov AS (SELECT t.session_id, t.segment_id, i, db, x FROM tr t JOIN so ON so.session_id = t.session_id AND a < t.end_seconds AND t.start_seconds < b WHERE t.end_seconds > t.start_seconds), fc AS (SELECT session_id, segment_id, count(*) AS n FROM ov GROUP BY ALL),
    vs AS (SELECT *, abs(x - lag(x) OVER (PARTITION BY session_id, segment_id ORDER BY i)) AS step FROM ov WHERE db >= -50), va2 AS (SELECT session_id, segment_id, count(*) AS vn, avg(x) AS mean, max(x) AS top, stddev_pop(x) AS std, coalesce(max(step), 0) AS step FROM vs GROUP BY ALL),
    sp AS (SELECT t.session_id, t.segment_id, coalesce(n, 0) AS frame_count, coalesce(vn, 0) AS voiced_frame_count, mean, top, std, step FROM tr t LEFT JOIN fc USING (session_id, segment_id) LEFT JOIN va2 USING (session_id, segment_id))"""


@query(
    "flatness_spikes",
    f"WITH {SEGMENTS_SQL}, {_SPIKES_SQL} SELECT session_id, segment_id, frame_count, voiced_frame_count, round(mean, 12) AS flatness_mean, round(top, 6) AS flatness_max, round(std, 5) AS flatness_std, round(step, 6) AS flatness_delta_max FROM sp",
)
def flatness_spikes(spark: SparkSession, d: str) -> DataFrame:
    rows = legacy.flatness_spikes(transcript(spark, d), _sounds(spark, d))
    return rows.select("session_id", "segment_id", "frame_count", "voiced_frame_count", *[F.round(c, n).alias(c) for c, n in (("flatness_mean", 12), ("flatness_max", 6), ("flatness_std", 5), ("flatness_delta_max", 6))])


@query("voiced_flatness", f"WITH {SEGMENTS_SQL}, {_SOUNDS_SQL} SELECT count(*) AS n, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.5), 6) AS median FROM so WHERE db > -50")
def voiced_flatness(spark: SparkSession, d: str) -> DataFrame:
    return legacy.voiced_flatness(_sounds(spark, d)).select("n", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))


_NAMES = ("Zoé Martin", "Ali Petit", "Eve Durand")


def _people(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("zoe martin", "deputy", 1), ("ali petit", "deputy", 2), ("eve durand", "minister", 3)], "normalized_name string, kind string, person_id long")


@query(
    "speaker_cluster_load",
    f"""WITH {SEGMENTS_SQL}, ev AS (SELECT session_id, speaker_id, segment_id % 3 + 1 AS p, sum(end_seconds - start_seconds) AS s FROM di WHERE segment_id % 5 <> 0 AND speaker_id IS NOT NULL GROUP BY ALL),
    ek AS (SELECT *, sum(s) OVER (PARTITION BY session_id, speaker_id) AS total, row_number() OVER (PARTITION BY session_id, speaker_id ORDER BY s DESC) AS r FROM ev),
    sp AS (SELECT session_id, speaker_id, sum(end_seconds - start_seconds) AS speech FROM di GROUP BY ALL)
    SELECT sp.session_id, sp.speaker_id AS label, row_number() OVER (PARTITION BY sp.session_id ORDER BY sp.speaker_id) AS cluster_id, round(speech, 3) AS total_detected_speech, p AS majority_person_id, round(s / total, 6) AS evidence_purity, round(s / speech, 6) AS absolute_purity
    FROM sp LEFT JOIN ek ON ek.session_id = sp.session_id AND ek.speaker_id = sp.speaker_id AND r = 1""",
)
def speaker_cluster_load(spark: SparkSession, d: str) -> DataFrame:
    turns = diarization(spark, d).withColumnRenamed("segment_id", "turn_id")
    person = F.struct(F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("turn_id") % 3 + 1).cast("int")).alias("name"), F.when(F.col("turn_id") % 3 == 2, "minister").otherwise("deputy").alias("kind"))
    evidence = turns.select("session_id", F.col("turn_id").alias("target_turn_id"), (F.col("turn_id") % 5 != 0).alias("eligible_for_cluster_majority"), person.alias("person"))
    rows = loading.cluster_rows(turns.select("session_id", F.col("speaker_id").alias("label")), turns, evidence, _people(spark))
    return rows.select("session_id", "label", "cluster_id", F.round("total_detected_speech", 3).alias("total_detected_speech"), "majority_person_id", F.round("evidence_purity", 6).alias("evidence_purity"), F.round("absolute_purity", 6).alias("absolute_purity"))


@query(
    "embedding_load",
    """WITH v AS (SELECT vec_id % 3 AS session_id, 0 AS part, vec_id AS turn_id, NULL AS chunk_index, len(embedding) AS dimension FROM embeddings UNION ALL SELECT vec_id % 3, 1, vec_id // 2, vec_id % 2, len(embedding) FROM embeddings WHERE vec_id % 4 < 2)
    SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY part, turn_id, chunk_index) AS embedding_id, session_id + 10 AS run_id, 'm' AS model_name, CAST(dimension AS INTEGER) AS dimension, 'float32' AS dtype, true AS normalized FROM v""",
)
def embedding_load(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select((F.col("vec_id") % 3).alias("session_id"), "vec_id", "embedding")
    said = vectors.withColumnRenamed("vec_id", "turn_id")
    index = (F.col("vec_id") % 2).cast("int")
    parts = vectors.filter("vec_id % 4 < 2").select("session_id", F.expr("vec_id div 2").alias("turn_id"), index.alias("chunk_index"), index.alias("start_sentence_index"), (index + 1).alias("end_sentence_index"), F.lit("x").alias("text"), "embedding")
    runs = spark.range(3).select(F.col("id").alias("session_id"), (F.col("id") + 10).alias("run_id"))
    return loading.embedding_rows(said, parts, runs, "m", True)[0].drop("vector")


# Words of conversations as a parse: every third word of a turn stands on its own, the others depend on the last such word.
_PARSE_SQL = """pw AS (SELECT conv_id, turn, string_split(text, ' ') AS ws FROM conversations WHERE text IS NOT NULL), pk AS (SELECT conv_id, turn, unnest(ws) AS word, unnest(range(len(ws))) AS k FROM pw),
    pt AS (SELECT *, CASE WHEN k % 3 = 0 THEN NULL ELSE k - k % 3 END AS h, CASE k % 3 WHEN 0 THEN CASE WHEN k % 2 = 0 THEN 'nsubj' ELSE 'root' END WHEN 1 THEN 'flat:name' ELSE 'appos' END AS dep, CASE WHEN k % 3 < 2 THEN 'PROPN' ELSE 'NOUN' END AS pos FROM pk)"""


@query(
    "person_candidates",
    f"""WITH {_PARSE_SQL}, ch AS (SELECT conv_id, turn, h AS k, string_agg(CASE WHEN dep = 'flat:name' THEN word END, ' ' ORDER BY k) AS flat, max(CASE WHEN dep = 'flat:name' THEN 2 ELSE 0 END) + max(CASE WHEN dep = 'appos' THEN 1 ELSE 0 END) AS below FROM pt WHERE h IS NOT NULL GROUP BY ALL),
    fu AS (SELECT pt.*, word || coalesce(' ' || flat, '') AS name, coalesce(below, 0) AS below FROM pt LEFT JOIN ch ON ch.conv_id = pt.conv_id AND ch.turn = pt.turn AND ch.k = pt.k),
    sc AS (SELECT a.conv_id, a.turn, a.k AS i, 1 + CASE WHEN a.pos = 'PROPN' THEN 3 ELSE 0 END + CASE a.dep WHEN 'flat:name' THEN 3 WHEN 'appos' THEN 2 WHEN 'nsubj' THEN 2 ELSE 0 END + CASE WHEN b.dep = 'nsubj' THEN 2 ELSE 0 END + CASE WHEN b.pos = 'PROPN' THEN 1 ELSE 0 END + CASE WHEN lower(b.word) IN ({", ".join(repr(t) for t in parsed.TITLES)}) THEN 2 ELSE 0 END + a.below AS score,
      CASE WHEN a.dep = 'flat:name' AND b.pos = 'PROPN' THEN b.name WHEN a.pos = 'PROPN' THEN a.name ELSE a.word END AS candidate_name FROM fu a LEFT JOIN fu b ON b.conv_id = a.conv_id AND b.turn = a.turn AND b.k = a.h)
    SELECT conv_id, turn, CAST(i AS INTEGER) AS i, CAST(score AS INTEGER) AS score, candidate_name FROM sc WHERE score > 6""",
)
def person_candidates(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").filter("text is not null")
    k = F.col("i")
    words = turns.select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("i", "text"))
    dep = F.when(k % 3 == 0, F.when(k % 2 == 0, "nsubj").otherwise("root")).when(k % 3 == 1, "flat:name").otherwise("appos")
    tokens = words.withColumns({"head_i": F.when(k % 3 != 0, k - k % 3), "dep": dep, "pos": F.when(k % 3 < 2, "PROPN").otherwise("NOUN"), "ent_type": F.lit("PER")})
    return parsed.person_candidates(tokens, keys=("conv_id", "turn")).select("conv_id", "turn", "i", "score", "candidate_name")


@query("language_shares", "SELECT lang, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM documents), 6) AS percent FROM documents GROUP BY lang")
def language_shares(spark: SparkSession, d: str) -> DataFrame:
    return parsed.shares(table(spark, d, "documents"), "lang").withColumn("percent", F.round("percent", 6))
