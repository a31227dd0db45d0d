"""Record schemas between stages, and the fixed small dimensions."""

from __future__ import annotations

SEGMENT = "STRUCT<label: STRING, start: DOUBLE, end: DOUBLE>"
KEY = "STRUCT<key: STRING, scale: STRING, strength: DOUBLE>"
CHORDS = "STRUCT<values: ARRAY<STRUCT<chord: STRING, timestamp: DOUBLE>>, progression: ARRAY<STRING>>"
BEATS = "STRUCT<values: ARRAY<STRUCT<timestamp: DOUBLE, beat: BIGINT>>, max_beat_number: BIGINT, bpm: DOUBLE>"
MELODY = "STRUCT<pitch_mean_hz: DOUBLE, pitch_median_hz: DOUBLE, num_voiced_frames: BIGINT>"
CHANGES = "ARRAY<STRUCT<time: DOUBLE, active: ARRAY<STRING>>>"

DATA = "audio_path STRING, duration DOUBLE, info STRING"
CAPTIONED = DATA + ", ALM_Caption STRING, _alm_prompt STRING, _error STRING"
MUSIC_CPU = f"audio_path STRING, music_cpu STRUCT<chords: {CHORDS}, beatnet: {BEATS}, melody: {MELODY}, key: {KEY}, chords_error: STRING, beatnet_error: STRING, essentia_error: STRING>"
MUSIC_GPU = f"audio_path STRING, music_gpu STRUCT<changes: {CHANGES}, frame_count: BIGINT, duration_sec: DOUBLE>"
STRUCTURE = DATA + f", songformer_result ARRAY<{SEGMENT}>"
CUT = "orig_audio_path STRING, audio_path STRING, info STRING, segment STRUCT<label: STRING, label_idx: BIGINT, label_numbered: STRING, start: DOUBLE, end: DOUBLE>, duration DOUBLE"
ASR = "audio_path STRING, `qwen3-omni-asr-result` STRING, error STRING"
SONG_SEGMENT = f"STRUCT<segment: STRING, label: STRING, idx: BIGINT, start: DOUBLE, end: DOUBLE, key: {KEY}, cut_audio_path: STRING, asr_text: STRING>"
SONG = f"audio_path STRING, song_structure_info ARRAY<{SONG_SEGMENT}>"
CAPTIONS = "audio_path STRING, caption STRING, caption_language STRING, caption_style STRING, caption_harmony_mode STRING, llm_merge_prompt STRING"
CHAT = "messages ARRAY<STRUCT<role: STRING, content: STRING>>, audios ARRAY<STRING>, meta STRUCT<source_file: STRING, source_idx: BIGINT, caption_style: STRING, caption_language: STRING, query_length_class: STRING, query_seed: STRING>"
PROGRESS = "type STRING, total_tasks BIGINT, timestamp DOUBLE, task_id BIGINT, completed_at DOUBLE"

# File extensions of audio and of video.
AUDIO_EXTENSIONS = [".mp3", ".flac", ".wav", ".m4a", ".aac", ".ogg", ".oga", ".wma", ".opus", ".ape", ".alac", ".aiff", ".aif", ".amr", ".mka", ".dts"]
VIDEO_EXTENSIONS = [".mp4", ".avi", ".mkv", ".mov", ".flv", ".wmv", ".webm", ".m4v", ".ts", ".mts", ".m2ts", ".vob", ".3gp", ".rm", ".rmvb"]
# The label ids that each structure dataset (0 to 8) allows; dataset 1 is the widened one, which has all below 64 but 26 and 39.
ALLOWED_LABELS = {
    0: [0, 1, 2, 3, 4, 5, 6],
    1: sorted(set(range(64)) - {26, 39}),
    2: [0, 1, 2, 3, 26, 39, 64, 65, 66, 67],
    3: [0, 1, 2, 3, 4, 5, 6, 26, 39, 64, 65, 66, 67],
    4: [0, 1, 2, 3, 4, 5, 6, 26],
    5: [0, 1, 2, 3, 4, 5, 6, 26],
    6: [0, 1, 2, 3, 4, 5, 6, 26],
    7: [0, 1, 2, 3, 4, 5, 6, 26],
    8: [0, 1, 2, 3, 4, 5, 6, 26],
}
# Temporary and superseded columns that an organised record loses.
TEMPORARY_COLUMNS = ["key_change", "qwen3_omni_asr_result", "Qwen3-Omni-I", "_alm_prompt", "_musicflamingo_prompt"]
