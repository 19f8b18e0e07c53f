"""Schemas of the nested documents, of the person list, and of the thirteen tables."""

from __future__ import annotations

_TIME = "struct<start_seconds: double, end_seconds: double, duration_seconds: double, start_ts: string, end_ts: string>"
_STAGE = "struct<status: string, output_path: string, completed_at: string, error_message: string>"
_PERSON = "struct<id: string, name: string, role: string, kind: string>"

DOCUMENT = f"""
schema_version string,
source struct<source_id: string, input_path: string, input_filename: string, media_type: string, language_expected: string, duration_seconds: double, file_sha256: string>,
pipeline struct<created_at: string, updated_at: string, stage_outputs: map<string, {_STAGE}>>,
vad struct<segments: array<struct<segment_id: int, time: {_TIME}, confidence: double>>>,
transcript struct<raw_tokens: array<struct<token_id: int, start_seconds: double, end_seconds: double, raw_token: string>>,
  raw_segments: array<struct<segment_id: int, start_token_id: int, end_token_id: int, time: {_TIME}, raw_text: string, avg_logprob: double, no_speech_prob: double, compression_ratio: double, flags: bigint>>>,
diarization struct<raw_segments: array<struct<segment_id: int, time: {_TIME}, speaker_id: string, flags: bigint, overlap_speaker_ids: array<string>>>,
  overlap_regions: array<struct<region_id: int, time: {_TIME}, speaker_ids: array<string>>>>,
alignment struct<transcript_diarization_matches: array<struct<transcript_segment_id: int, diarization_segment_ids: array<int>, speaker_ids: array<string>, probable_speaker_id: string,
  speaker_overlap_seconds: map<string, double>, speaker_longest_overlap_seconds: map<string, double>, speaker_overlap_segment_count: map<string, int>, speaker_evidence_score: map<string, double>,
  total_overlap_seconds: double, winning_overlap_seconds: double, winning_evidence_score: double, speaker_confidence: double, flags: bigint>>>
""".replace("\n", " ")

TURNS = f"""
turns array<struct<turn_id: int, audio_time: {_TIME}, text: string, speaker_id: string, speaker_confidence: double, transcript_segment_ids: array<int>, diarization_segment_ids: array<int>, speaker_evidence_ratio: double, flags: bigint>>,
turns_analysis array<struct<turn_id: int, keywords: array<string>, current_speaker: {_PERSON}, current_speaker_source: string, current_speaker_purity: double, mentioned_persons: array<{_PERSON}>, mentioned_organizations: array<string>, mentioned_locations: array<string>,
  evidence: array<struct<source: string, eligible_for_cluster_majority: boolean, person: {_PERSON}, source_turn_id: int, target_turn_id: int, source_speaker_id: string, target_speaker_id: string, speaker_raw: string, speaker_normalized: string, match_score: double, is_known_person: boolean>>>>
""".replace("\n", " ")

FRAMES = ("frames array<struct<frame_index: int, frame_center_seconds: double, rms: double, db: double, zcr: double, spectral_centroid: double, spectral_bandwidth: double, spectral_flatness: double, db_rolling_median: double, db_delta: double>>")

PEOPLE_HEADER = ("identifiant", "Prénom", "Nom", "Région", "Département", "Numéro de circonscription", "Profession", "Groupe politique (complet)", "Groupe politique (abrégé)")

#: Tables of the relational model; keys hold for one session, so session_id is part of them.
TABLES = {
    "session": "session_id long, slug string, title string, date date, source_url string, duration_seconds double, vad_duration double, audio_file_hash string",
    "pipeline_run": "session_id long, run_id long, stage string, schema_ver string, engine_name string, model string, device string, config_json string",
    "person": "person_id long, normalized_name string, kind string, name string, external_id string, party string, role string",
    "speaker_cluster": "session_id long, cluster_id long, label string, total_detected_speech double, majority_person_id long, evidence_purity double, absolute_purity double",
    "transcript_segment": "session_id long, segment_id long, run_id long, text string, start_seconds double, end_seconds double, flags long, avg_logprob double, no_speech_prob double, compression_ratio double",
    "diarization_segment": "session_id long, segment_id long, run_id long, cluster_id long, start_seconds double, end_seconds double, flags long, overlap_speaker_ids string",
    "turn": "session_id long, turn_id long, cluster_id long, speaker_confidence double, speaker_evidence_ratio double, text string, start_seconds double, end_seconds double, flags long",
    "turn_analysis": "session_id long, turn_id long, current_person_id long, source string, purity double, keywords string, evidence string, mentioned_persons string, organizations string",
    "turn_transcript_segment": "session_id long, turn_id long, segment_id long",
    "turn_diarization_segment": "session_id long, turn_id long, segment_id long",
    "embedding": "session_id long, embedding_id long, run_id long, model_name string, dimension int, vector array<float>, dtype string, normalized boolean",
    "semantic_chunk": "session_id long, turn_id long, chunk_index int, run_id long, start_sentence_index int, end_sentence_index int, text string, embedding_id long",
    "turn_embedding": "session_id long, turn_id long, embedding_id long",
}
#: What makes a row of each table unique.
UNIQUE = {
    "session": ("slug",),
    "pipeline_run": ("session_id", "stage"),
    "person": ("normalized_name", "kind"),
    "speaker_cluster": ("session_id", "label"),
    "transcript_segment": ("session_id", "segment_id"),
    "diarization_segment": ("session_id", "segment_id"),
    "turn": ("session_id", "turn_id"),
    "turn_analysis": ("session_id", "turn_id"),
    "turn_transcript_segment": ("session_id", "turn_id", "segment_id"),
    "turn_diarization_segment": ("session_id", "turn_id", "segment_id"),
    "embedding": ("session_id", "embedding_id"),
    "semantic_chunk": ("session_id", "turn_id", "chunk_index"),
    "turn_embedding": ("session_id", "turn_id", "embedding_id"),
}
#: (table, columns, referenced table, referenced columns)
REFERENCES = (
    ("transcript_segment", ("session_id", "run_id"), "pipeline_run", ("session_id", "run_id")),
    ("diarization_segment", ("session_id", "cluster_id"), "speaker_cluster", ("session_id", "cluster_id")),
    ("turn", ("session_id", "cluster_id"), "speaker_cluster", ("session_id", "cluster_id")),
    ("turn_analysis", ("session_id", "turn_id"), "turn", ("session_id", "turn_id")),
    ("turn_transcript_segment", ("session_id", "turn_id"), "turn", ("session_id", "turn_id")),
    ("turn_transcript_segment", ("session_id", "segment_id"), "transcript_segment", ("session_id", "segment_id")),
    ("turn_diarization_segment", ("session_id", "turn_id"), "turn", ("session_id", "turn_id")),
    ("turn_diarization_segment", ("session_id", "segment_id"), "diarization_segment", ("session_id", "segment_id")),
    ("semantic_chunk", ("session_id", "turn_id"), "turn", ("session_id", "turn_id")),
    ("semantic_chunk", ("session_id", "embedding_id"), "embedding", ("session_id", "embedding_id")),
    ("turn_embedding", ("session_id", "embedding_id"), "embedding", ("session_id", "embedding_id")),
)
