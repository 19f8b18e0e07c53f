"""Decoder output, anchors, sidecars, anomalies, loaded rows, voice prints and the command line."""

import json
import wave
from dataclasses import dataclass

import numpy as np
import pytest
from pyspark.errors import PySparkException

from sessionlens import __main__ as cli
from sessionlens.operators import audit, decoding, legacy, loading, parsed
from sessionlens.sources import models, readers, sinks

WORDS = "session_id long, ord int, start_seconds double, end_seconds double, text string, words array<struct<start: double, end: double, word: string>>"


def test_decoded(spark):
    found = spark.createDataFrame([
        (1, 0, 0.0, 1.0, " Bonjour à tous ", [(0.0, 0.4, " Bonjour"), (None, 0.6, " à"), (0.6, 1.0, " tous")]),
        (1, 1, 1.0, 2.0, None, None),
        (1, 2, 2.0, 2.5, "", []),
        (1, 3, 2.5, 3.0, "oui", [(2.5, 3.0, " oui"), (2.6, 2.7, None)]),
        (2, 0, 0.0, 9.0, "x", [(0.0, 9.0, "x")]),
    ], WORDS)
    segments, tokens = decoding.decoded(found)
    rows = segments.orderBy("session_id", "segment_id").select("session_id", "segment_id", "start_token_id", "end_token_id", "raw_text").collect()
    assert [tuple(r) for r in rows] == [(1, 1, 0, 1, "Bonjour à tous"), (1, 2, None, None, ""), (1, 3, None, None, ""), (1, 4, 2, 2, "oui"), (2, 1, 0, 0, "x")]
    assert [tuple(r) for r in tokens.orderBy("session_id", "token_id").select("session_id", "token_id", "raw_token").collect()] == [(1, 0, " Bonjour"), (1, 1, " tous"), (1, 2, " oui"), (2, 0, "x")]
    assert {r["session_id"]: r["duration_seconds"] for r in decoding.media_seconds(segments).collect()} == {1: 3.0, 2: 9.0}
    assert {r["session_id"]: r["text"] for r in decoding.token_text(tokens, "session_id").collect()} == {1: " Bonjour tous oui", 2: "x"}
    assert decoding.decoded(found.limit(0))[1].count() == 0


def pointer(tokens, segments):
    """The segment of each token by two pointers."""
    out, at, segments = [], 0, sorted(segments, key=lambda s: (s[1], s[0]))
    for i, (a, b) in enumerate(tokens):
        anchor = (a + (tokens[i + 1][1] if i + 1 < len(tokens) else b)) / 2
        while at < len(segments) and anchor > segments[at][2]:
            at += 1
        out.append(segments[at][0] if at < len(segments) and segments[at][1] <= anchor else None)
    return out


def test_by_anchor(spark):
    g = np.random.default_rng(3)
    starts = np.cumsum(g.uniform(0, 3, 60)).round(2)
    tokens = [(float(a), float(a) + 0.5) for a in starts]
    edges = np.cumsum(g.uniform(0.5, 9, 40)).round(2)
    segments = [(i + 1, float(edges[2 * i]), float(edges[2 * i + 1])) for i in range(20)]
    left = spark.createDataFrame([(1, i, a, b) for i, (a, b) in enumerate(tokens)], "session_id long, token_id long, start_seconds double, end_seconds double")
    right = spark.createDataFrame([(1, *s) for s in segments], "session_id long, segment_id long, start_seconds double, end_seconds double")
    found = decoding.by_anchor(left, right, width=5.0).orderBy("token_id").collect()
    wanted = pointer(tokens, segments)
    assert [r["segment_id"] for r in found] == wanted and None in wanted and len(set(wanted)) > 5
    assert all(r["segment_id"] is None for r in decoding.by_anchor(left, right.limit(0)).collect())


def test_zipped_lengths(spark):
    df = spark.createDataFrame([([1, 2], ["a", "b"]), (None, ["a"])], "x array<int>, y array<string>")
    rows = df.select(decoding.zipped(df.x, df.y).alias("z")).collect()
    assert [tuple(p) for p in rows[0]["z"]] == [(1, "a"), (2, "b")] and rows[1]["z"] is None
    bad = spark.createDataFrame([([1], ["a", "b"])], "x array<int>, y array<string>")
    with pytest.raises(PySparkException, match="different lengths"):
        bad.select(decoding.zipped(bad.x, bad.y).alias("z")).collect()


def test_sidecar(spark):
    columns = "session_id long, segment_id long, start_seconds double, end_seconds double, text string, avg_logprob double, no_speech_prob double, flags long"
    said = spark.createDataFrame([(1, 1, 0.0, 2.0, "été à", -0.2, 0.1, 0), (1, 2, 5.0, 6.0, None, None, None, 0)], columns)
    voice = spark.createDataFrame([(1, 0.0, 1.0)], "session_id long, start_seconds double, end_seconds double")
    frames = spark.createDataFrame([(1, 0, 0.5, -20.0, 0.0, 0.2, 0.4), (1, 1, 1.5, -40.0, 1.0, 0.4, 0.2)], "session_id long, frame_index int, frame_center_seconds double, db double, db_delta double, rms double, zcr double")
    rows = said.withColumn("compression_ratio", audit.F.lit(None).cast("double"))
    rows = audit.sidecar(audit.audited(rows, voice, frames, voice.limit(0))).orderBy("segment_id").collect()
    assert rows[0].asDict().keys() == {"session_id", *audit.SIDECAR}
    a = rows[0]
    assert (a["text_char_count"], a["text_word_count"], a["text_byte_cout"]) == (4, 2, 7)
    assert a["vad_coverage"] == 0.5 and a["rms_mean"] == pytest.approx(0.3) and a["zcr_mean"] == pytest.approx(0.3) and a["flag_names"] == ["PARTIAL_VAD_OVERLAP"]
    assert rows[1]["frame_count"] == 0 and rows[1]["rms_mean"] is None and "OUTSIDE_VAD" in rows[1]["flag_names"]


def test_spikes_against_plain(spark):
    g = np.random.default_rng(5)
    frames = [(1, i, i * 0.1, i * 0.1 + 0.1, float(g.uniform(-70, -10)), float(g.choice([0.1, 0.12, 0.5], p=[0.6, 0.3, 0.1]))) for i in range(200)]
    segments = [(1, k + 1, k * 0.9, k * 0.9 + 0.75) for k in range(20)] + [(1, 99, 500.0, 501.0)]
    left = spark.createDataFrame(segments, "session_id long, segment_id long, start_seconds double, end_seconds double")
    right = spark.createDataFrame(frames, "session_id long, frame_index int, start_seconds double, end_seconds double, db double, spectral_flatness double")
    found = {r["segment_id"]: r for r in legacy.flatness_spikes(left, right).collect()}
    spikes = 0
    for _, k, a, b in segments:
        inside = [f for f in frames if min(b, f[3]) - max(a, f[2]) > 0]
        x = np.array([f[5] for f in inside if f[4] >= -50])
        r = found[k]
        assert (r["frame_count"], r["voiced_frame_count"]) == (len(inside), len(x))
        if not len(x):
            assert r["flatness_mean"] is None and not r["spike"]
            continue
        step = np.abs(np.diff(x)).max() if len(x) > 1 else 0.0
        assert (r["flatness_mean"], r["flatness_max"], r["flatness_std"], r["flatness_delta_max"]) == pytest.approx((x.mean(), x.max(), x.std(), step))
        spikes += r["spike"]
        assert r["spike"] == ((x.std() > 0 and (x.max() - x.mean()) / x.std() >= 2) or step >= 0.15)
    assert 0 < spikes < 21


def test_doubtful(spark):
    said = spark.createDataFrame([(1, k, k * 1.0, k + 1.0, v) for k, v in enumerate([-0.2, -0.2, -0.21, -0.5, -0.2, -0.2, None])], "session_id long, segment_id long, start_seconds double, end_seconds double, avg_logprob double")
    frames = spark.createDataFrame([(1, 0, 3.0, 3.5, -10.0, 0.3)], "session_id long, frame_index int, start_seconds double, end_seconds double, db double, spectral_flatness double")
    rows = {r["segment_id"]: r for r in legacy.doubtful(said, frames).collect()}
    assert set(rows) == {3, 4} and set(rows[3]["reasons"]) == {"sharp_drop", "large_abs_delta", "local_low_z"} and rows[4]["reasons"] == ["large_abs_delta"]
    assert rows[3]["voiced_frame_count"] == 1 and rows[4]["frame_count"] == 0


def test_cluster_rows(spark):
    turns = spark.createDataFrame([(1, 1, "A", 0.0, 4.0), (1, 2, "A", 4.0, 10.0), (1, 3, None, 10.0, 30.0), (1, 4, "B", 30.0, 31.0)], "session_id long, turn_id long, speaker_id string, start_seconds double, end_seconds double")
    evidence = spark.createDataFrame([(1, 1, True, ("Zoé", "deputy")), (1, 2, False, ("Ali", "deputy")), (1, 3, True, ("Ali", "deputy"))], "session_id long, target_turn_id long, eligible_for_cluster_majority boolean, person struct<name: string, kind: string>")
    people = spark.createDataFrame([("zoe", "deputy", 7), ("ali", "deputy", 8)], "normalized_name string, kind string, person_id long")
    labels = turns.selectExpr("session_id", "speaker_id label").filter("label is not null").union(spark.createDataFrame([(1, "C")], "session_id long, label string"))
    rows = loading.cluster_rows(labels, turns, evidence, people).orderBy("cluster_id").collect()
    assert [(r["label"], r["total_detected_speech"], r["majority_person_id"]) for r in rows] == [("A", 10.0, 7), ("B", 1.0, None), ("C", 0.0, None)]
    assert rows[0]["evidence_purity"] == 1.0 and rows[0]["absolute_purity"] == pytest.approx(0.4)


def test_embedding_rows(spark):
    a = spark.createDataFrame([(1, 2, [1.0, 2.0]), (1, 1, [3.0, 4.0])], "session_id long, turn_id long, embedding array<float>")
    b = spark.createDataFrame([(1, 1, 0, 0, 2, "x", [5.0, 6.0])], "session_id long, turn_id long, chunk_index int, start_sentence_index int, end_sentence_index int, text string, embedding array<float>")
    runs = spark.createDataFrame([(1, 9, "semantic_chunk")], "session_id long, run_id long, stage string")
    vectors, turns, chunks = loading.embedding_rows(a, b, runs, "m", True)
    assert [(r["embedding_id"], r["vector"][0], r["dimension"], r["run_id"]) for r in vectors.orderBy("embedding_id").collect()] == [(1, 3.0, 2, 9), (2, 1.0, 2, 9), (3, 5.0, 2, 9)]
    assert sorted((r["turn_id"], r["embedding_id"]) for r in turns.collect()) == [(1, 1), (2, 2)] and chunks.collect()[0]["embedding_id"] == 3
    with pytest.raises(PySparkException, match="different dimensions"):
        loading.embedding_rows(a, b.withColumn("embedding", audit.F.array(audit.F.lit(1.0).cast("float"))), runs, "m", True)[0].collect()
    with pytest.raises(loading.InvalidArtifact):
        loading.embedding_rows(a, b, runs, "", True)
    assert loading.run_id(runs, 1, "semantic_chunk") == 9
    with pytest.raises(loading.MissingReference):
        loading.run_id(runs, 1, "turns")


def test_voice_prints(spark):
    files = spark.createDataFrame([(1, bytearray(b"abc"), 10.0)], "session_id long, content binary, duration_seconds double")
    segments = spark.createDataFrame([(1, 1, "A", 2.0, 4.0), (1, 2, "B", 5.0, 5.05), (1, 3, "A", 6.0, 6.2), (2, 1, "A", 0.0, 1.0)], "session_id long, segment_id long, speaker_id string, start_seconds double, end_seconds double")
    rows = models.voice_prints(files, segments, lambda: lambda audio, a, b: np.array([[len(audio), b - a]])).orderBy("segment_id").collect()
    assert [(r["segment_id"], r["embedding"][0]) for r in rows] == [(1, 3.0), (3, 3.0)]
    assert [r["embedding"][1] for r in rows] == pytest.approx([2.0, 0.8], abs=1e-5)


def test_metadata(tmp_path):
    values = {"model_name": "m", "min_words": 3}
    sinks.save_metadata(values, tmp_path / "m.json", tmp_path / "m.txt")
    assert readers.metadata(str(tmp_path / "m.json")) == values
    assert (tmp_path / "m.txt").read_text() == "Semantic chunk embedding metadata\n\nmodel_name: m\nmin_words: 3\n"
    (tmp_path / "bad.json").write_text("[1]")
    with pytest.raises(readers.InvalidInput):
        readers.metadata(str(tmp_path / "bad.json"))

    @dataclass
    class Engine:
        name: str = "é"

    assert json.loads(loading.config_json(Engine())) == {"name": "é"}


def test_command_line(spark, tmp_path, capsys):
    cli.main(["list"])
    assert "segment_audit" in capsys.readouterr().out.split()
    spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.1])], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    cli.main(["search", "1", "--tables", str(tmp_path), "--top", "1", "--out", f"{tmp_path}/out"])
    assert [r["vec_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [3]
    with pytest.raises(SystemExit):
        cli.main(["run", "nothing", "--tables", "x"])


def test_person_candidates(spark):
    columns = "segment_id int, i int, text string, pos string, dep string, head_i int, ent_type string"
    tokens = spark.createDataFrame([
        (1, 0, "Madame", "NOUN", "nsubj", 3, None), (1, 1, "Claire", "PROPN", "appos", 0, "PER"), (1, 2, "Lenoir", "PROPN", "flat:name", 1, "PER"),
        (1, 3, "parle", "VERB", "root", None, None), (2, 0, "Paul", "PROPN", "vocative", None, "PER"), (2, 1, "toit", "NOUN", "obj", 0, "PER"),
    ], columns)
    rows = {(r["segment_id"], r["i"]): (r["score"], r["candidate_name"]) for r in parsed.person_candidates(tokens).collect()}
    # 1 + 3 + 2 (appos) + 2 (head nsubj) + 2 (title) + 2 (flat child); 1 + 3 + 3 + 1 (head PROPN)
    assert rows == {(1, 1): (12, "Claire Lenoir"), (1, 2): (8, "Claire Lenoir")}
    assert parsed.person_candidates(tokens.limit(0)).count() == 0


def test_phrase_persons(spark):
    said = spark.createDataFrame([(1, "La PAROLE est à Paul."), (2, "Bonjour Paul"), (3, "la parole est libre"), (4, None)], "segment_id int, text string")
    entities = spark.createDataFrame([(1, 1, "PER", "Paul"), (1, 0, "LOC", "Lyon"), (2, 0, "PER", "Paul")], "segment_id int, ord int, label string, text string")
    assert {r["segment_id"]: r["persons"] for r in parsed.phrase_persons(said, entities).collect()} == {1: ["Paul"], 3: []}


def test_resampled_waves(spark, tmp_path):
    rate, t = 48000, np.arange(48000 * 3) / 48000
    tone, high = np.sin(2 * np.pi * 440 * t), np.sin(2 * np.pi * 12000 * t)
    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(rate)
        w.writeframes(((tone + high) * 0.4 * 32767).astype("<i2").tobytes())
    rows = readers.waves(spark, str(tmp_path), seconds=1.0, rate=16000).orderBy("first_sample").collect()
    assert [(r["rate"], r["first_sample"], len(r["samples"])) for r in rows] == [(16000, k * 16000, 16000) for k in range(3)]
    found = np.concatenate([r["samples"] for r in rows])
    wanted = 0.4 * np.sin(2 * np.pi * 440 * np.arange(48000) / 16000)
    assert np.abs(found - wanted)[200:-200].max() < 2e-3  # the tone beyond 8 kHz is gone, seams don't show
    plain = readers.waves(spark, str(tmp_path), seconds=1.0).orderBy("first_sample").collect()
    assert sum(len(r["samples"]) for r in plain) == 48000 * 3 and plain[1]["first_sample"] == 48000
