"""Readers, writers, runs, hooks and streams."""

import json
import wave
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlens.plans import runs
from sessionlens.sources import models, readers, schemas, sinks
from sessionlens.streaming import turns as stream


def test_people_list(spark, tmp_path):
    line = '"d:1","Alice","Dupont","R","D","1","Juriste","Groupe","G"'
    header = ",".join(f'"{h}"' for h in schemas.PEOPLE_HEADER)
    good = tmp_path / "good.csv"
    good.write_text(header + "\n" + line + "\n" + line.replace("d:1", "minister:2") + "\n", encoding="utf-8")
    got = readers.known_people(spark, str(good), str(good)).orderBy("src_order").collect()
    assert [(r["name"], r["kind"], r["role"]) for r in got] == [("Alice Dupont", "deputy", "Député")] * 3 + [("Alice Dupont", "minister", "Juriste")]
    good.write_text(header + "\n" + line.replace("d:1", "assembly_chari:2").replace("Juriste", " ") + "\n", encoding="utf-8")
    assert [(r["kind"], r["role"]) for r in readers.known_people(spark, ministers=str(good)).collect()] == [("assembly_chair", None)]
    bad = tmp_path / "bad.csv"
    bad.write_text(header + "\n" + '"a","b"\n', encoding="utf-8")
    with pytest.raises(Exception, match="malformed rows: 2"):
        readers.people(spark, str(bad)).collect()


def test_documents_and_turns(spark, tmp_path):
    doc = {"source": {"source_id": "s"}, "vad": {"segments": [{"segment_id": 1, "time": {"start_seconds": 0.5, "end_seconds": 2.0}}]}}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    rows = readers.section(readers.documents(spark, str(tmp_path / "d.json")), "vad.segments").collect()
    assert [(r["segment_id"], r["start_seconds"], r["end_seconds"]) for r in rows] == [(1, 0.5, 2.0)]
    (tmp_path / "t.json").write_text(json.dumps({"turns": [{"turn_id": 1}], "turns_analysis": [{"turn_id": 2}]}))
    with pytest.raises(Exception, match="not aligned"):
        readers.turn_documents(spark, str(tmp_path / "t.json")).collect()


def test_archives_and_waves(spark, tmp_path):
    np.savez(tmp_path / "e.npz", turn_ids=np.arange(3, dtype=np.int32), embeddings=np.eye(3, dtype=np.float32))
    got = readers.archives(spark, str(tmp_path / "e.npz")).orderBy("ord").collect()
    assert [json.loads(r["ids"])["turn_ids"] for r in got] == [0, 1, 2] and got[1]["vector"] == [0, 1, 0]
    np.savez(tmp_path / "f.npz", turn_ids=np.arange(2), embeddings=np.eye(3, dtype=np.float32))
    with pytest.raises(Exception, match="must have 3 values"):
        readers.archives(spark, str(tmp_path / "f.npz")).collect()
    (tmp_path / "w").mkdir()
    with wave.open(str(tmp_path / "w/a.WAV"), "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(np.array([[16384, 0]] * 100, np.int16).tobytes())
    x = readers.waves(spark, str(tmp_path / "w")).first()
    assert x["rate"] == 8000 and len(x["samples"]) == 100 and x["samples"][0] == 0.25
    assert readers.candidates(spark, str(tmp_path / "w")).count() == 1
    assert len(readers.file_hashes(spark, str(tmp_path / "w")).first()["sha8"]) == 8


def test_html_rows(spark):
    page = "<table><tr><td>a</td></tr><tr><td data-sort='x_y'>1</td><td>2</td><td> 3 4</td></tr></table>"
    got = readers.html_rows(spark.createDataFrame([(1, page)], "page_id long, html string")).collect()
    assert [(r["cells"], r["sort_parts"]) for r in got] == [(["1", "2", "3 4"], ["x", "y"])]


def test_tables_all_or_nothing(spark, tmp_path):
    target = str(tmp_path / "db")
    assert sinks.save_tables({"a": spark.range(3)}, target) == {"a": 3}
    with pytest.raises(sinks.OutputExists):
        sinks.save_tables({"a": spark.range(3)}, target)
    broken = spark.range(3).select(F.when(F.col("id") == 1, F.raise_error(F.lit("no"))).otherwise(F.lit("x")).alias("y"))
    with pytest.raises(Exception):  # noqa: B017
        sinks.save_tables({"a": spark.range(5), "b": broken}, target, replace=True)
    assert spark.read.parquet(f"{target}/a").count() == 3
    assert sinks.save_tables({"a": spark.range(5)}, target, replace=True) == {"a": 5}


def test_transcript_lines(spark):
    rows = spark.createDataFrame([(1, 0.0, 3661.5, "bonjour")], "segment_id long, start_seconds double, end_seconds double, raw_text string")
    assert sinks.transcript_lines(rows).first()[0] == "[00:00:00.00 -> 01:01:01.50] bonjour"


def test_runs(tmp_path):
    assert [(runs.stem_date(s), runs.slug(s)) for s in ("session-2026-06-19-title", "20260619_qag_simplification", "1ere-seance-14-avril-2026-qag", "plain session")] == [("2026-06-19", "session-title"), ("2026-06-19", "qag-simplification"), ("2026-04-14", "1ere-seance-qag"), (None, "plain-session")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.wav").write_bytes(b"x")
    done = runs.process(tmp_path / "in/a.wav", tmp_path, {"vad": lambda r: {"out": str(r.folder / "v.json")}})
    assert done.manifest["status"] == "completed" and done.manifest["stages"][0]["artifacts"] == {"out": "v.json"} and done.source.parent.name == "processed"
    (tmp_path / "in/b.wav").write_bytes(b"y")
    seen = []

    def fail(run):
        raise RuntimeError("boom")

    with pytest.raises(RuntimeError):
        runs.process(tmp_path / "in/b.wav", tmp_path, {"vad": fail, "turns": seen.append})
    assert not seen and (tmp_path / "failed/b.wav").exists()
    (tmp_path / "in/c.txt").write_text("z")
    assert runs.process(tmp_path / "in/c.txt", tmp_path, {}).manifest["status"] == "skipped_invalid_input"
    assert runs.Run.begin(tmp_path / "processed/a.wav", tmp_path / "r", today=date(2026, 1, 2)).folder.name.startswith("2026-01-02_no-date_a_")
    again = runs.Run.begin(tmp_path / "processed/a.wav", tmp_path / "r", today=date(2026, 1, 2))
    assert again.folder.name.endswith("-2") and len(list((tmp_path / "r").iterdir())) == 2
    (tmp_path / "in/a.wav").write_bytes(b"x")
    assert sinks.move_file(tmp_path / "in/a.wav", tmp_path / "processed").name == "a-2.wav"
    assert [runs.stem_date(x) for x in ("seance_9 Juin_2026", "le 3-AOUT-2025", "1 fevrier 2024", "12-décembre-2025")] == ["2026-06-09", "2025-08-03", "2024-02-01", "2025-12-12"]
    assert runs.slug("seance 14 avril 2026 QAG é") == "seance-qag-e"


def test_hooks(spark):
    rows = spark.createDataFrame([(1, "dog dog"), (2, None)], "id long, text string")
    got = models.encoded(rows, "text", lambda: lambda t: np.array([[len(x), 1.0] for x in t])).orderBy("id").collect()
    assert got[1]["embedding"] == [0.0, 1.0] and abs(sum(x * x for x in got[0]["embedding"]) - 1) < 1e-6
    found = models.entities(rows, "text", ["id"], lambda: lambda t: [{"entity_group": "PER", "score": 0.9, "word": w, "start": 0, "end": 3} for w in t.split()])
    assert found.count() == 2


def test_stream_closes_turns(spark, tmp_path):
    rows = [(1, 1, "A", 0.0, 2.0, "a"), (1, 2, "A", 3.0, 4.0, "b"), (1, 3, "B", 5.0, 6.0, "c"), (1, 4, "B", 60.0, 61.0, "d")]
    spark.createDataFrame(rows, stream.SEGMENT).coalesce(1).write.json(str(tmp_path / "in"))
    q = stream.newly_arrived(spark, str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "out"))
    q.awaitTermination(120)
    got = spark.read.schema(stream.TURN).parquet(str(tmp_path / "out")).orderBy("start_seconds").collect()
    assert [(r["speaker_id"], r["segments"], r["text"]) for r in got] == [("A", 2, "a b"), ("B", 1, "c")]
