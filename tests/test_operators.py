"""Literal cases and small models of the session operators."""

import random
import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sessionlens.functions import flags, fuzzy, text
from sessionlens.operators import alignment, audit, chunking, identity, intervals, legacy, loading, turns

SEG = "session_id long, segment_id long, speaker_id string, start_seconds double, end_seconds double"
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
some_segments = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40), st.integers(1, 12)), min_size=1, max_size=12)


def made(spark, items):
    return spark.createDataFrame([(1, i, f"S{s}", a / 2, (a + n) / 2) for i, (s, a, n) in enumerate(items, 1)], SEG)


def test_sentences(spark):
    row = spark.createDataFrame([("Bonjour à tous. Ça va ? Très bien! L’État avance… oui", "...!?", "  les Français  avancent vite ", "a b")], "a string, b string, c string, d string")
    got = row.select(text.split_sentences(F.col("a")), text.split_sentences(F.col("b")), text.count_words(F.col("c")), text.count_words(F.col("d"))).first()
    assert got[0] == ["Bonjour à tous", "Ça va", "Très bien", "L’État avance… oui"]
    assert got[1] == [] and got[2] == 4 and got[3] == 2


def test_breakpoints(spark):
    rows = spark.createDataFrame([(1, i, v) for i, v in enumerate([[1.0, 0.0]] * 3 + [[0.0, 1.0]] * 2)], "k int, i int, embedding array<float>")
    got = chunking.adjacent(rows, ("k",), "i").orderBy("i").collect()
    assert [r["cosine"] for r in got] == [None, 1, 1, 0, 1]
    assert [r["delta"] for r in got] == [None, None, 0, -1, 1]
    assert [r["i"] for r in got if r["is_break"]] == [3]


def test_chunks_of_animals(spark):
    words = ["dog"] * 3 + ["cat"] * 2 + ["dog"] * 2 + ["bird"] * 2
    vec = {"dog": [1.0, 0.0], "cat": [0.0, 1.0], "bird": [-1.0, 0.0]}
    turn = spark.createDataFrame([(1, 1, ". ".join(words) + ".")], "session_id long, turn_id long, text string")
    parts = chunking.sentences(turn)
    vectors = spark.createDataFrame([(1, 1, i, vec[w]) for i, w in enumerate(words)], "session_id long, turn_id long, sentence_index int, embedding array<float>")
    got = chunking.chunks(parts, vectors, min_words=0)
    assert sorted((r["start_sentence_index"], r["end_sentence_index"]) for r in got.collect()) == [(0, 3), (3, 5), (5, 7), (7, 9)]
    again = chunking.rebuilt_text(got.drop("text"), turn).join(got.withColumnRenamed("text", "t"), ["session_id", "turn_id", "chunk_index"])
    assert again.filter("text <> t").count() == 0
    # only long sentences decide: with eight words and more there is one chunk
    assert chunking.chunks(parts, vectors).count() == 1


def test_names(spark):
    row = spark.createDataFrame([("  Élodie   Députée  ",)], "n string")
    assert row.select(text.normalize_name(F.col("n"))).first()[0] == "elodie deputee"
    assert fuzzy.ratio("abc", "abc") == 100 and fuzzy.ratio("", "") == 100 and fuzzy.wratio("", "a") == 0
    assert fuzzy.name_score("alice", "alice") == 100 and fuzzy.name_score("alice", "alice dupont") == 0
    assert fuzzy.token_sort_ratio("b a", "a b") == 100 and fuzzy.partial_ratio("bc", "abcd") == 100


@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
def test_ratio_is_a_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    want = 200 * table[-1][-1] / (len(a) + len(b)) if a or b else 100
    assert fuzzy.ratio(a, b) == pytest.approx(want)


def test_threshold_keeps_bare_name(spark):
    known = spark.createDataFrame([("2", "Laurent Marcangeli", None, "minister", 1)], "id string, name string, role string, kind string, src_order long")
    names = spark.createDataFrame([("laurent marcangelli",)], "name string")
    assert identity.resolved_names(names, known).first()["kind"] == "minister"
    assert identity.resolved_names(names, known, identity.IdentityConfig(min_match=100)).first()["kind"] == "raw_per"


def test_handoff_names_next_speaker(spark):
    said = "La parole est à Alice Dupont avec Bob Martin."
    talk = spark.createDataFrame([(1, 1, "CHAIR", said), (1, 2, "S_A", "Merci.")], "session_id long, turn_id long, speaker_id string, text string")
    found = [(1, 1, 0, "PER", 0.99, "Alice Dupont", 16, 28), (1, 1, 1, "PER", 0.99, "Bob Martin", 34, 44), (1, 1, 2, "PER", 0.8, "Low Score", 0, 2)]
    entities = spark.createDataFrame(found, "session_id long, turn_id long, ord int, entity_group string, score double, word string, start int, end int")
    mentions = identity.person_mentions(entities)
    assert mentions.count() == 2
    known = spark.createDataFrame([("1", "Alice Dupont", None, "deputy", 1)], "id string, name string, role string, kind string, src_order long")
    names = identity.resolved_names(mentions.select(F.col("word").alias("name")), known)
    guess = identity.predictions(mentions, talk)
    assert [(r["word"], r["predicted_turn_id"]) for r in guess.collect()] == [("Alice Dupont", 2)]
    proof = identity.evidence_of(guess, names, talk)
    vote = identity.voted(proof, ["session_id", "target_speaker_id"]).first()
    assert (vote["votes"], vote["total_votes"], vote["purity"]) == (2, 2, 1.0)
    who = {r["turn_id"]: (r["current_person"]["name"], r["source"]) for r in identity.turn_identities(talk, proof).collect()}
    assert who == {1: ("Yaël Braun-Pivet", "hardcoded_assembly_chair"), 2: ("Alice Dupont", "chair_next_speaker_call")}
    people = identity.mentioned(mentions, names).first()["mentioned_persons"]
    assert [p["name"] for p in people] == ["Alice Dupont", "bob martin"]  # nobody known: the normalised name


def test_closest_name_equals_comparing_all():
    rng = random.Random(5)
    parts = ["jean", "marie", "dupont", "dupond", "martin", "le", "pen", "braun-pivet", "yael", "chaix", "bernard", "laurent", "marcangeli", "de", "la", "tour"]
    known = [" ".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(120)]
    names = fuzzy.Names(known)
    for _ in range(150):
        query = " ".join(rng.choices([*parts, "dupon", "marcangelli", "zz", "bern"], k=rng.randint(2, 4)))
        scores = [fuzzy.wratio(query, k) for k in known]
        best = max(scores)
        assert names.closest(query) == (scores.index(best), best), query


def test_best_name_is_guarded_after_the_match(spark):
    """The closest name decides; another that would pass the guard does not take its place."""
    known = spark.createDataFrame([("1", "Alicia Dupontel", None, "deputy", 0), ("2", "Alice Durand", None, "deputy", 1), ("3", "Zoé", None, "deputy", 2), ("4", "Max", None, "deputy", 3), ("5", "Max", None, "deputy", 4)], "id string, name string, role string, kind string, src_order long")
    names = spark.createDataFrame([(n,) for n in ("Alice Dupontel", "Alicia Dupontel", "ZOÉ", "Max", "Élodie Inconnue", "Zo")], "name string")
    got = {r["name"]: (r["id"], r["resolved_name"], r["match_score"] > 0) for r in identity.resolved_names(names, known).collect()}
    assert got["Alice Dupontel"][0] == "1" and got["Alicia Dupontel"][0] == "1" and got["ZOÉ"] == ("3", "Zoé", True)
    assert got["Max"] == (None, "max", False) and got["Élodie Inconnue"] == (None, "elodie inconnue", True) and got["Zo"] == (None, "zo", False)
    with pytest.raises(identity.TooManyPeople):
        identity.resolved_names(names, known, identity.IdentityConfig(most_people=4))


def test_generic_mentions_and_kinds(spark):
    words = ["Madame la députée", "MONSIEUR  LE MINISTRE", "Madame Dupont", "ministre"]
    df = spark.createDataFrame([("PER", 0.9, w) for w in words], "entity_group string, score double, word string")
    assert [r["word"] for r in identity.person_mentions(df).collect()] == ["Madame Dupont", "ministre"]
    kinds = spark.createDataFrame([(x,) for x in ("minister:a", "assembly_chair:b", "assembly_chari:b", "assembly_chaii:b", "assemby_chair:b", "PA1")], "id string").select(identity.person_kind(F.col("id")).alias("k"))
    assert [r["k"] for r in kinds.collect()] == ["minister", "assembly_chair", "assembly_chair", "assembly_chair", "deputy", "deputy"]


def test_evidence_of_turns(spark):
    talk = spark.createDataFrame([(1, 1, "C", "La séance est ouverte. La parole est à Bob Lee.", 0.0, 4.0), (1, 2, "S", "Merci.", 4.0, 14.0), (1, 3, "S", "Suite.", 14.0, 20.0), (1, 4, "T", "Vous avez la parole, Bob Lee", 20.0, 21.0), (1, 5, "S", "Oui.", 21.0, 22.0)], "session_id long, turn_id long, speaker_id string, text string, start_seconds double, end_seconds double")
    mentions = spark.createDataFrame([(1, 1, 0, "Bob Lee", 39, 46), (1, 4, 1, "Bob Lee", 21, 28)], "session_id long, turn_id long, ord int, word string, start int, end int")
    known = spark.createDataFrame([("7", "Bob Lee", "Député", "deputy", 0)], "id string, name string, role string, kind string, src_order long")
    names = identity.resolved_names(mentions.select(F.col("word").alias("name")), known)
    proof = identity.evidence_of(identity.predictions(mentions, talk), names, talk)
    assert sorted((r["source_turn_id"], r["target_turn_id"], r["source"], r["eligible_for_cluster_majority"]) for r in proof.collect()) == [(1, 2, "chair_next_speaker_call", True), (4, 5, "chair_next_speaker_call", True)]
    lists = {r["turn_id"]: [(e["source"], e["person"]["name"], e["match_score"]) for e in r["evidence"]] for r in identity.turn_evidence(talk, proof).collect()}
    assert lists == {1: [("hardcoded_assembly_chair", "Yaël Braun-Pivet", 100.0)], 2: [("chair_next_speaker_call", "Bob Lee", 100.0)], 4: [("hardcoded_assembly_chair", "Yaël Braun-Pivet", 100.0)], 5: [("chair_next_speaker_call", "Bob Lee", 100.0)]}
    ranked = {r["speaker_id"]: (r["person_key"]["normalized_name"], r["evidence_purity"], r["absolute_purity"]) for r in identity.cluster_majorities(identity.majority_evidence(talk, proof), talk).collect()}
    assert ranked["S"] == ("bob lee", 1.0, 11 / 17) and ranked["C"][0] == "yael braun-pivet"
    who = {r["turn_id"]: (r["current_person"]["name"], r["source"], r["purity"]) for r in identity.turn_identities(talk, proof).collect()}
    assert who[3] == ("Bob Lee", "propagated_from_speaker_cluster", 1.0) and who[2][1] == "chair_next_speaker_call" and who[4][1] == "hardcoded_assembly_chair"


def test_turns_carry_flags_and_own_evidence(spark):
    said = spark.createDataFrame([(1, 1, 0.0, 4.0, "a", 1), (1, 2, 4.0, 8.0, "b", 0), (1, 3, 30.0, 31.0, "c", 0)], "session_id long, segment_id long, start_seconds double, end_seconds double, text string, flags long")
    heard = spark.createDataFrame([(1, 1, "A", 0.0, 3.0, 0), (1, 2, "B", 2.5, 4.0, 1 << 30), (1, 3, "A", 4.0, 8.0, 0)], "session_id long, segment_id long, speaker_id string, start_seconds double, end_seconds double, flags long")
    match = alignment.elected(said, heard).orderBy("transcript_segment_id").collect()
    scores = match[0]["speaker_evidence_score"]
    assert match[0]["speaker_confidence"] == pytest.approx(scores["A"] / (scores["A"] + scores["B"])) and match[2]["speaker_confidence"] is None
    turn = turns.consolidated(alignment.elected(said, heard), said, heard).collect()
    assert len(turn) == 1 and turn[0]["text"] == "a b" and turn[0]["flags"] == 1 | 1 << 30 | 1 << 31
    assert turn[0]["speaker_evidence_ratio"] == pytest.approx(7 / 8)  # A alone: 0 to 3 and 4 to 8


def test_unknown_speakers_do_not_merge(spark):
    rows = spark.createDataFrame([(1, 1, None, 0.0, 1.0), (1, 2, None, 1.0, 2.0), (1, 3, "A", 2.0, 3.0), (1, 4, "A", 3.0, 4.0)], SEG)
    assert [r["turn_id"] for r in turns.turn_numbers(rows, ("start_seconds",)).orderBy("segment_id").collect()] == [1, 2, 3, 3]


def test_keys_that_are_not_loaded(spark):
    rows = spark.createDataFrame([(1, "A"), (1, None), (2, "A")], "session_id long, speaker_id string")
    clusters = spark.createDataFrame([(1, "A", 5)], "session_id long, label string, cluster_id long")
    assert [r["cluster_id"] for r in loading.with_clusters(rows.filter("session_id = 1"), clusters).orderBy("speaker_id").collect()] == [None, 5]
    with pytest.raises(Exception, match="speaker cluster not loaded: A"):
        loading.with_clusters(rows, clusters).collect()
    who = spark.createDataFrame([(1, ("Élodie  Martin", "deputy")), (2, None)], "turn_id long, current_person struct<name: string, kind: string>")
    people = spark.createDataFrame([("elodie martin", "deputy", 9)], "normalized_name string, kind string, person_id long")
    assert [r["person_id"] for r in loading.with_persons(who, people).orderBy("turn_id").collect()] == [9, None]
    with pytest.raises(Exception, match="person not loaded"):
        loading.with_persons(who, people.withColumn("kind", F.lit("minister"))).collect()
    lists = spark.createDataFrame([(1, [("x", None)]), (2, None)], "turn_id long, e array<struct<source: string, target: string>>")
    assert [r[0] for r in lists.orderBy("turn_id").select(loading.evidence_json(F.col("e"))).collect()] == ['[{"source":"x","target":null}]', "[]"]


def test_look_ahead_over_one_speaker(spark):
    rows = spark.createDataFrame([(1, i, "CHAIR") for i in (1, 2, 3)], "session_id long, turn_id long, speaker_id string")
    got = {r["turn_id"]: r["predicted_turn_id"] for r in identity.looked_ahead(rows).collect()}
    assert got == {1: 2, 2: 3, 3: None}


def test_majority(spark):
    proof = [(1, "S", "a", 10.0), (1, "S", "b", 5.0)]
    talk = spark.createDataFrame([(1, "S", 0.0, 40.0)], "session_id long, speaker_id string, start_seconds double, end_seconds double")
    schema = "session_id long, speaker_id string, person_key string, seconds double"
    got = identity.cluster_majorities(spark.createDataFrame(proof, schema), talk).first()
    assert (got["evidence_purity"], got["absolute_purity"]) == (10 / 15, 10 / 40)
    with pytest.raises(identity.MajorityTie):
        identity.cluster_majorities(spark.createDataFrame([(1, "S", "a", 5.0), (1, "S", "b", 5.0)], schema), talk)


def test_crop(spark):
    row = spark.createDataFrame([(1799.5, 1800.064, 1800.064), (10.0, 10.4, 100.0), (0.1, 0.2, 100.0)], "a double, b double, d double")
    clamp = row.select(legacy.clamped(F.col("a"), F.col("b"), F.col("d")).alias("x")).select("x.*").collect()
    assert tuple(clamp[0]) == pytest.approx((1799.064, 1799.064))
    grown = row.select(legacy.crop(F.col("a"), F.col("b"), F.col("d")).alias("x")).select("x.*").collect()
    assert all(b - a == pytest.approx(0.8) for a, b in grown)
    odd = spark.createDataFrame([(0.1, 0.3, 0.9), (8.0, 12.0, 10.0), (5.0, 5.1, 9.2), (1.0, 1.1, 1.5)], "a double, b double, d double")
    got = [tuple(r) for r in odd.select(legacy.crop(F.col("a"), F.col("b"), F.col("d")).alias("x")).select("x.*").collect()]
    assert got == [pytest.approx(x) for x in [(0.0, 0.8), (5.0, 9.0), (4.65, 5.45), (0.0, 0.5)]]  # short recordings keep their last second; late intervals shift
    assert tuple(grown[2]) == pytest.approx((0.0, 0.8))


def test_flags(spark):
    value = flags.mask("OUTSIDE_VAD", "IMPOSSIBLE_SPEECH_RATE")
    row = spark.createDataFrame([(value,)], "f long")
    got = row.select(flags.flag_names(F.col("f")), flags.has_flag(F.col("f"), "OUTSIDE_VAD"), flags.has_flag(F.col("f"), "NO_SUCH")).first()
    assert got[0] == ["IMPOSSIBLE_SPEECH_RATE", "OUTSIDE_VAD"] and got[1] and not got[2]
    assert len(flags.FLAGS) == 22 and flags.flag_table(spark).count() == 22


def test_density_flags(spark):
    rows = spark.createDataFrame([(0.0, 0.3, "un deux trois quatre cinq"), (0.0, 9.0, "oui"), (0.0, 5.0, "tout va bien"), (1.0, 1.0, "x")], "start_seconds double, end_seconds double, text string")
    got = [r[0] for r in rows.select(audit.density_flags()).collect()]
    assert got == [flags.mask("IMPOSSIBLE_SPEECH_RATE", "INFORMATION_RATE_TOO_HIGH"), flags.mask("LONG_DURATION_SHORT_TEXT"), 0, 0]


def test_election_tie_takes_smaller_speaker(spark):
    said = spark.createDataFrame([(1, 1, 0.0, 4.0), (1, 2, 50.0, 51.0)], "session_id long, segment_id long, start_seconds double, end_seconds double")
    who = spark.createDataFrame([(1, 1, "B", 0.0, 2.0), (1, 2, "A", 2.0, 4.0)], SEG)
    got = {r["transcript_segment_id"]: r for r in alignment.elected(said, who).collect()}
    assert got[1]["probable_speaker_id"] == "A" and got[1]["speaker_confidence"] == 0.5
    assert got[1]["flags"] == flags.mask("MULTI_SPEAKER_CANDIDATE", "TIE_BREAK_SPEAKER")
    assert got[1]["speaker_evidence_score"] == {"A": 3.0, "B": 3.0}
    assert got[2]["probable_speaker_id"] is None and got[2]["speaker_confidence"] is None and got[2]["flags"] == 0


@few
@given(some_segments)
def test_sweep(spark, items):
    edges = sorted({x / 2 for _, a, n in items for x in (a, a + n)})
    want = []
    for a, b in zip(edges, edges[1:], strict=False):
        who = sorted({f"S{s}" for s, x, n in items if x / 2 <= a and (x + n) / 2 >= b})
        if len(who) > 1:
            want.append((a, b, who))
    got = intervals.overlap_regions(made(spark, items), width=3.0).orderBy("region_id").collect()
    assert [(r["start_seconds"], r["end_seconds"], r["speaker_ids"]) for r in got] == want


@few
@given(some_segments)
def test_merge(spark, items):
    want = []
    for a, b in sorted((a / 2, (a + n) / 2) for _, a, n in items):
        if want and a <= want[-1][1]:
            want[-1][1] = max(want[-1][1], b)
        else:
            want.append([a, b])
    got = intervals.merged(made(spark, items)).orderBy("start_seconds").collect()
    assert [[r["start_seconds"], r["end_seconds"]] for r in got] == want


@few
@given(some_segments)
def test_turn_numbers(spark, items):
    rows = sorted(((a / 2, i, f"S{s}", (a + n) / 2) for i, (s, a, n) in enumerate(items, 1)))
    number, last, want = 0, None, {}
    for a, i, s, b in rows:
        if last is None or s != last[0] or a - last[1] > 5.0:
            number, last = number + 1, (s, b)
        else:
            last = (s, max(last[1], b))
        want[i] = number
    got = turns.turn_numbers(made(spark, items), ("start_seconds", "segment_id")).collect()
    assert {r["segment_id"]: r["turn_id"] for r in got} == want


@few
@given(some_segments, some_segments)
def test_overlap_join(spark, left, right):
    a = made(spark, left).select("session_id", F.col("segment_id").alias("a_id"), F.col("start_seconds").alias("a_start"), F.col("end_seconds").alias("a_end"))
    b = made(spark, right).select("session_id", F.col("segment_id").alias("b_id"), F.col("start_seconds").alias("b_start"), F.col("end_seconds").alias("b_end"))
    want = sorted((i, j) for i, (_, x, n) in enumerate(left, 1) for j, (_, y, m) in enumerate(right, 1) if min(x + n, y + m) > max(x, y))
    assert sorted((r["a_id"], r["b_id"]) for r in intervals.overlap_join(a, b, width=2.0).collect()) == want


def test_consolidated_turns(spark):
    said = spark.createDataFrame([(1, 1, 0.0, 2.0, "un ", 1), (1, 2, 2.0, 4.0, "deux", 2), (1, 3, 30.0, 31.0, "trois", 0), (1, 4, 90.0, 91.0, "perdu", 0)], "session_id long, segment_id long, start_seconds double, end_seconds double, text string, flags long")
    who = spark.createDataFrame([(1, 1, "A", 0.0, 2.0), (1, 2, "A", 2.0, 4.0), (1, 3, "A", 30.0, 31.0)], SEG)
    got = turns.consolidated(alignment.elected(said, who), said, who).orderBy("turn_id").collect()
    assert [(r["text"], r["start_seconds"], r["end_seconds"], r["flags"], r["transcript_segment_ids"], r["diarization_segment_ids"]) for r in got] == [("un  deux", 0.0, 4.0, 3, [1, 2], [1, 2]), ("trois", 30.0, 31.0, 0, [3], [3])]
    assert got[0]["speaker_confidence"] == 1.0 and got[0]["speaker_evidence_ratio"] == 1.0


def test_segment_audit(spark):
    said = spark.createDataFrame([(1, 1, 0.0, 4.0, "bonjour à tous", 0, -2.0, 0.1, 1.0), (1, 2, 10.0, 30.0, "rien", 0, -0.1, 0.9, 3.0)], "session_id long, segment_id long, start_seconds double, end_seconds double, text string, flags long, avg_logprob double, no_speech_prob double, compression_ratio double")
    voice = spark.createDataFrame([(1, 0.0, 1.0), (1, 2.0, 4.0)], "session_id long, start_seconds double, end_seconds double")
    frames = spark.createDataFrame([(1, i, i / 2, -60.0 - i) for i in range(10)], "session_id long, frame_index int, frame_center_seconds double, db double")
    regions = spark.createDataFrame([(1, 0.5, 1.0)], "session_id long, start_seconds double, end_seconds double")
    got = {r["segment_id"]: r for r in audit.audited(said, voice, audit.rolling_median(frames), regions).collect()}
    assert set(got[1]["flags"] and spark.createDataFrame([(got[1]["flags"],)], "f long").select(flags.flag_names(F.col("f"))).first()[0]) == {"LOW_WHISPER_CONFIDENCE", "PARTIAL_VAD_OVERLAP", "DISCONTIGUOUS_VAD_COVERAGE", "DIARIZATION_OVERLAP"}
    assert got[1]["frame_count"] == 9 and got[1]["coverage"] == 0.75
    assert got[2]["flags"] == flags.mask("OUTSIDE_VAD", "HIGH_NO_SPEECH_PROB", "HIGH_COMPRESSION_RATIO", "LONG_DURATION_SHORT_TEXT", "LONG_WHISPER_SEGMENT_LOW_VAD_COVERAGE")


def test_load_checks(spark):
    turn = spark.createDataFrame([(1, 1, 1), (1, 1, 1)], "session_id long, turn_id long, cluster_id long")
    with pytest.raises(loading.DuplicateRows):
        loading.validate({"turn": turn})
    cluster = spark.createDataFrame([(1, 2, "A")], "session_id long, cluster_id long, label string")
    with pytest.raises(loading.MissingReference):
        loading.validate({"turn": turn.distinct(), "speaker_cluster": cluster})
    people = spark.createDataFrame([(1, "a", "Ann", None, "k"), (2, "b", "ann", None, "k")], "ord long, id string, name string, role string, kind string")
    with pytest.raises(loading.ExternalIdConflict):
        loading.persons(people)
    assert loading.persons(people.withColumn("id", F.when(F.col("ord") == 2, "b"))).first()["external_id"] == "b"
    with pytest.raises(loading.InvalidId):
        loading.validate_ids(spark.createDataFrame([(0,)], "id long"), "id")
    with pytest.raises(loading.InvalidArtifact):
        loading.validate_vectors(spark.createDataFrame([([1.0, float("nan")],)], "v array<float>"), "v", 2)
    assert loading.conformed(turn, "turn").columns[:3] == ["session_id", "turn_id", "cluster_id"]
    assert loading.upserted(loading.persons(people.limit(1)).drop("ord"), loading.persons(people.filter("ord = 2")).drop("ord")).count() == 1


def test_frames_and_flow(spark):
    import numpy as np

    tone = (0.5 * np.sin(2 * np.pi * 1000 * np.arange(8000) / 16000)).astype(np.float32)
    piece = spark.createDataFrame([("x", 16000, tone.tolist())], "path string, rate int, samples array<float>")
    got = legacy.spectral_frames(piece).orderBy("frame_index").collect()
    assert len(got) == 1 + (8000 - 4096) // 1600 and got[0]["frame_center_seconds"] == 2048 / 16000
    assert abs(got[0]["spectral_centroid"] - 1000) < 5 and abs(got[0]["rms"] - 0.5 / 2**0.5) < 1e-3
    assert abs(got[0]["zcr"] - 0.125) < 0.01 and got[0]["spectral_flatness"] < 0.01
    rows = spark.createDataFrame([(1, 1, "A", 0.0, 1.0, "x" * 500 + "."), (1, 2, "A", 1.0, 2.0, "b"), (1, 3, "B", 2.0, 3.0, "c"), (1, 4, "B", 9.0, 10.0, "d")], SEG + ", text string")
    assert [r["group_id"] for r in legacy.grouped_by_flow(rows).orderBy("segment_id").collect()] == [1, 1, 2, 2]  # one segment closes no sentence; another speaker ends the group
    texts = ["word " * 12, "more words here and there until it is long enough " * 2 + "end.", "next.", "part", "z " * 450, "tail", "Done.", "x", "y"]
    speakers, others = ["A"] * 7 + ["A", None], [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.5, 0.0]
    flow = spark.createDataFrame([(1, k, s, float(k), k + 1.0, t, o) for k, (t, s, o) in enumerate(zip(texts, speakers, others))], SEG + ", text string, other_seconds double")
    assert [r["group_id"] for r in legacy.grouped_by_flow(flow).orderBy("segment_id").collect()] == [1, 1, 2, 2, 2, 3, 3, 4, 5]
    quiet = spark.createDataFrame([("y", 16000, [0.9] * 4096 + [0.0] * 9000)], "path string, rate int, samples array<float>")
    levels = [r["db"] for r in legacy.spectral_frames(quiet).orderBy("frame_index").collect()]
    assert max(levels) - min(levels) == pytest.approx(80, abs=1e-3)
    values = spark.createDataFrame([(0.0,), (1.0,)], "x double")
    assert [round(r["density"], 4) for r in legacy.density(values, "x", [0.0, 0.5, 1.0], 1.0).orderBy("point").collect()] == [0.3205, 0.3521, 0.3205]


def test_vectors_as_bytes_and_axes(spark):
    from sessionlens.functions import vectors

    df = spark.createDataFrame([(1, [1.0, 2.0, 0.5]), (2, None), (3, [])], "id long, v array<float>")
    got = {r["id"]: (r["b"], r["back"]) for r in df.withColumn("b", vectors.to_bytes("v")).withColumn("back", vectors.from_bytes(F.col("b"))).collect()}
    assert got[1] == (bytearray(struct.pack("<3f", 1, 2, 0.5)), [1.0, 2.0, 0.5]) and got[2] == (None, None) and got[3] == (bytearray(), [])
    assert spark.createDataFrame([(bytearray(b"abc"),)], "b binary").select(vectors.from_bytes("b")).first()[0] is None
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 4)) * [5, 2, 0.1, 0.1] + [3, 1, 0, 0]
    rows = vectors.principal_components(spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, v array<double>"), "v").orderBy("id").collect()
    found = np.array([r["components"] for r in rows])
    _, _, axes = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert np.allclose(np.abs(found), np.abs((x - x.mean(axis=0)) @ axes[:2].T), atol=1e-6)
