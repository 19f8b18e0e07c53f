"""Figures of intervals without a row for each pair, against all pairs."""

import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlens.functions import fuzzy, text
from sessionlens.functions.ranges import Greatest, Ranked, Spans, Sums
from sessionlens.operators import alignment, audit, intervals, legacy, turns
from sessionlens.plans import catalog

FOLDER = "/root/testdata/sf0.001"
#: Queries whose rows aren't pairs: their plans must join no pairs.
NO_PAIRS = [
    "multi_speaker_segments",
    "midpoint_assignment",
    "token_anchors",
    "longest_overlap_assignment",
    "flatness_spikes",
    "speaker_election",
    "speaker_scores",
    "overlap_regions",
    "partial_overlap_spread",
    "vad_flags",
    "vad_coverage",
    "raw_segment_overlap_flags",
    "segment_audit",
    "frame_stats_per_segment",
    "turns_from_alignment",
]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", NO_PAIRS)
def test_no_row_for_each_pair(spark, name):
    plan = catalog.QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" not in plan and "FlatMapCoGroupsInArrow" in plan


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", ["other_speaker_overlaps", "interval_overlap_join"])
def test_pairs_are_shuffled_and_not_broadcast(spark, name):
    plan = catalog.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def crowd(seed, n=60, speakers=3):
    """Rows (segment_id, speaker_id, start, end) that lie densely, some equal and some without length, over several stretches of time."""
    rng = np.random.default_rng(seed)
    start = rng.integers(0, 120, n) * 500.0
    return [(k + 1, f"S{rng.integers(speakers)}", float(s), float(s + x)) for k, (s, x) in enumerate(zip(start, rng.integers(0, 40, n) * 500.0, strict=True))]


def made(spark, rows):
    return spark.createDataFrame([(1, *r, f"t{r[0]}", r[0] % 4) for r in rows], "session_id long, segment_id long, speaker_id string, start_seconds double, end_seconds double, text string, flags long")


def test_range_kernels():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n, m = rng.integers(1, 40), 30
        x, s = rng.integers(0, 60, n) / 2, rng.integers(0, 70, m) / 2
        y, e, ident = x + rng.integers(0, 30, n) / 2, s + rng.integers(0, 30, m) / 2, rng.permutation(n)
        shared = np.maximum(np.minimum(y, e[:, None]) - np.maximum(x, s[:, None]), 0)
        if len(spans := Spans(x, y, ident)):
            assert (spans.count(s, e) == (shared > 0).sum(1)).all() and (spans.seconds(s, e) == shared.sum(1)).all()
            best, at = spans.longest(s, e)
            for i in range(m):
                met = [k for k in range(n) if shared[i, k] > 0]
                assert best[i] == shared[i].max() and (spans.place[at[i]] == min(met, key=lambda k: (-shared[i, k], x[k], ident[k])) if met else at[i] == -1)
        held = Spans(x, y, ident, False).holding(s)
        for i in range(m):
            met = [k for k in range(n) if x[k] <= s[i] <= y[k]]
            assert Spans(x, y, ident, False).place[held[i]] == min(met, key=lambda k: (x[k], ident[k])) if met else held[i] == -1
        v, lo = rng.integers(0, 10, 50) / 3, rng.integers(0, 49, m)
        hi = lo + 1 + rng.integers(0, 50 - lo)
        parts = [v[a:b] for a, b in zip(lo, hi, strict=True)]
        for p in (0.1, 0.5, 0.95):
            assert np.allclose(Ranked(v).percentile(lo, hi, p), [np.percentile(w, p * 100) for w in parts])
        assert np.allclose(Sums(v).mean(lo, hi), [w.mean() for w in parts]) and np.allclose(Sums(v).deviation(lo, hi), [w.std() for w in parts])
        assert (Greatest(v).over(lo, hi) == [w.max() for w in parts]).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_aligned_turns_are_the_consolidated_ones(spark, seed):
    left, right = made(spark, crowd(seed)), made(spark, crowd(seed + 10))
    want = turns.consolidated(alignment.elected(left, right), left, right, 700.0).drop("diarization_segment_ids")
    show = lambda df: [[round(v, 9) if isinstance(v, float) else v for v in r] for r in df.orderBy("turn_id").collect()]
    got = show(turns.aligned(left, right, max_silence=700.0))
    assert got == show(want) and len(got) > 3


def test_long_texts_are_compared_in_batches():
    """All windows of two texts of 1500 and 6000 characters; one by one they take minutes."""
    rng = random.Random(4)
    made = lambda n: "".join(rng.choice("abc éd  ") for _ in range(n))
    pairs = [(made(rng.choice([0, 1, 5, 30, 70])), made(rng.choice([0, 1, 2, 9, 30]))) for _ in range(150)]
    assert fuzzy.partial_ratios(pairs) == [fuzzy.partial_ratio(a, b) for a, b in pairs]
    assert fuzzy.wratios(pairs) == [fuzzy.wratio(a, b) for a, b in pairs]
    for a, b in pairs:
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        assert text.edits(a, b) == text.edits(list(a), list(b)) == row[-1]
    long = made(6000)
    assert fuzzy.partial_ratios([(long[2000:3500], long)]) == [100.0]


def test_character_rates_of_texts(spark):
    rows = spark.createDataFrame([("chat", "chats"), ("", "é"), ("x", ""), (None, "a"), ("a", None), ("un 𝄞 là", "un la")], "a string, b string")
    got = rows.select(text.cer_of_texts("a", "b"), text.cer(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [r[1] for r in got]


def test_frames_of_crowded_segments(spark):
    rows = crowd(3)
    rng = np.random.default_rng(9)
    sounds = [(1, k, float(t), None if k % 11 == 0 else float(rng.integers(-60, 0)), float(rng.integers(0, 20)) / 7) for k, t in enumerate(np.sort(rng.integers(0, 160, 400) * 500.0))]
    frames = spark.createDataFrame(sounds, "session_id long, frame_index long, frame_center_seconds double, db double, db_delta double")
    got = {r["segment_id"]: r for r in audit.frame_stats(made(spark, rows), frames).collect()}
    for i, _, s, e in rows:
        inside = [x for x in sounds if s <= x[2] <= e]
        db = [x[3] for x in inside if x[3] is not None]
        assert got[i]["frame_count"] == len(inside) and (got[i]["db_mean"] is None) == (not db)
        if db:
            want = [np.mean(db), *np.percentile(db, [10, 50, 90]), np.percentile([x[4] for x in inside], 95)]
            assert np.allclose([got[i][c] for c in ("db_mean", "db_p10", "db_p50", "db_p90", "db_delta_p95")], want)


def test_voice_of_crowded_segments(spark):
    rows, said = crowd(4), crowd(6, 30)
    for empty in (0.0, 1.0):
        got = {r["segment_id"]: r for r in audit.voice_coverage(made(spark, rows), made(spark, said), empty=empty).collect()}
        for i, _, s, e in rows:
            parts = sorted((max(s, x), min(e, y)) for _, _, x, y in said if min(e, y) > max(s, x))
            gap = max((x - max(b for _, b in parts[:k]) for k, (x, _) in enumerate(parts) if k), default=0)
            want = min(1, sum(b - a for a, b in parts) / (e - s)) if e > s else empty
            assert (got[i]["coverage"], got[i]["max_gap_seconds"]) == (pytest.approx(want), max(gap, 0))


def test_segments_without_length_inside_a_region(spark):
    rows = made(spark, [(1, "S0", 0.0, 10.0), (2, "S1", 4.0, 8.0), (3, "S2", 5.0, 5.0), (4, "S1", 5.0, 5.0), (5, "S2", 4.0, 4.0), (6, "S2", 9.0, 9.0)])
    got = {r["segment_id"]: r["overlap_speaker_ids"] for r in intervals.other_speakers(rows, intervals.overlap_regions(rows)).collect()}
    assert got == {1: ["S1"], 2: ["S0"], 3: ["S0", "S1"], 4: ["S0"], 5: [], 6: []}


def without_length(spark, folder):
    """Tables of three events at one moment, of which the text segment has no length."""
    rows = [(0, 0, "view", 0.0), (1, 0, "error", 50.0), (2, 3, "purchase", 50.0)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double").withColumn("ts", F.expr("timestamp '2024-01-02 00:00:00' - make_interval(0, 0, 0, 0, 0, 0, event_id)"))
    events.write.parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["vad_coverage", "vad_flags"])
def test_text_without_length_as_in_sql(spark, tmp_path, name):
    folder = without_length(spark, tmp_path)
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{folder}/events.parquet/*.parquet')")
    want = con.sql(catalog.ORACLES[name]).df()
    got = catalog.QUERIES[name](spark, folder).toPandas()[list(want.columns)]
    assert got.values.tolist() == want.values.tolist() and len(got) == 1


def test_assignments_of_crowded_segments(spark):
    rows, others = crowd(7), crowd(8)
    left = made(spark, rows).selectExpr("session_id", "segment_id a_id", "start_seconds a_start", "end_seconds a_end")
    right = made(spark, others).selectExpr("session_id", "segment_id b_id", "speaker_id", "start_seconds b_start", "end_seconds b_end")
    best = {r["a_id"]: (r["b_id"], r["overlap_seconds"]) for r in intervals.by_longest_overlap(left, right).collect()}
    middle = {r["a_id"]: r["b_id"] for r in intervals.by_midpoint(left, right).collect()}
    shared = {(r["a_id"], r["b_id"]): r["overlap_seconds"] for r in intervals.overlap_join(left, right).collect()}
    assert intervals.overlap_join(left, right).count() == len(shared)
    want = {(i, j): min(e, y) - max(s, x) for i, _, s, e in rows for j, _, x, y in others if min(e, y) > max(s, x)}
    assert shared == want
    for i, _, s, e in rows:
        met = [(-want[i, j], x, j) for j, _, x, _ in others if (i, j) in want]
        assert best.get(i) == ((min(met)[2], -min(met)[0]) if met else None)
        held = [(x, j) for j, _, x, y in others if x <= (s + e) / 2 <= y]
        assert middle.get(i) == (min(held)[1] if held else None)


def test_each_pair_of_long_intervals_meets_once(spark):
    """A pair that shares 100 buckets is joined in one of them, not in all."""
    left = spark.createDataFrame([(1, 1, 0.0, 6000.0)], "session_id long, a_id long, a_start double, a_end double")
    right = spark.createDataFrame([(1, 2, 30.0, 6000.0)], "session_id long, b_id long, b_start double, b_end double")
    pairs = intervals.overlap_join(left, right)
    assert [r["overlap_seconds"] for r in pairs.collect()] == [5970.0]
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2 and plan.count("Generate explode") == 2


@pytest.mark.parametrize("ordered", [True, False])
def test_frames_that_overlap_crowded_segments(spark, ordered):
    rows, rng = crowd(12, 30), np.random.default_rng(2)
    start = np.sort(rng.integers(0, 160, 300) * 500.0)
    length = np.full(300, 250.0) if ordered else rng.integers(1, 9, 300) * 250.0
    sounds = [(1, k, float(t), float(t + n), float(rng.integers(-70, 0)), None if k % 13 == 0 else float(rng.integers(0, 50)) / 9) for k, (t, n) in enumerate(zip(start, length, strict=True))]
    frames = spark.createDataFrame(sounds, "session_id long, frame_index long, start_seconds double, end_seconds double, db double, spectral_flatness double")
    got = {r["segment_id"]: r for r in legacy.flatness_spikes(made(spark, rows), frames).collect()}
    for i, _, s, e in rows:
        inside = [x for x in sounds if min(e, x[3]) > max(s, x[2])]
        voiced = [x[5] for x in inside if x[4] >= -50]
        known = [x for x in voiced if x is not None]
        r = got[i]
        assert (r["frame_count"], r["voiced_frame_count"]) == (len(inside), len(voiced))
        step = max((abs(b - a) for a, b in zip(voiced, voiced[1:], strict=False) if a is not None and b is not None), default=0.0)
        want = [np.mean(known), max(known), np.std(known)] if known else [None] * 3
        assert [r["flatness_mean"], r["flatness_max"], r["flatness_std"]] == pytest.approx(want) if known else r["flatness_mean"] is None
        assert r["flatness_delta_max"] == (step if voiced else None)
