"""The annotation pipeline, step by step, as functions of DataFrames; models are backends given by the caller."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.config import Settings
from cadenza.functions import sampling as H
from cadenza.functions import text as X
from cadenza.operators import aggregates as G
from cadenza.operators import joins as J
from cadenza.operators import prompts as M
from cadenza.operators import quality as Q
from cadenza.operators import reshape as R
from cadenza.operators import sequences as S
from cadenza.operators.backends import Backend, run_backend
from cadenza.sources.media import media_kind, valid_duration


@dataclass(frozen=True)
class Models:
    """Makers of backends; each gives the field named in its step."""

    duration: Callable[[], Backend]
    caption: Callable[[], Backend]
    transcript: Callable[[], Backend]
    final_caption: Callable[[], Backend]
    query: Callable[[], Backend]


def scan(files: DataFrame, models: Models, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(data, failures) of a listing with ``path``: media files with a valid duration, and all others that were tried."""
    media = files.filter(media_kind(F.col("path")).isNotNull()).select(F.col("path").alias("audio_path"))
    probed = run_backend(media, models.duration, "duration DOUBLE", attempts=settings.attempts)
    good = F.col("error").isNull() & valid_duration(F.col("duration"))
    data = probed.filter(good).select("audio_path", "duration", F.concat(F.lit("duration: "), X.seconds_to_clock(F.col("duration"))).alias("info"))
    return data, probed.filter(~good).select(F.col("audio_path").alias("path"), F.coalesce("error", F.lit("no valid duration")).alias("fail_reason"))


def cut(songs: DataFrame, settings: Settings) -> DataFrame:
    """One row per clip of songs with ``segments``: numbered, padded, filtered and named."""
    rows = R.segments_of(songs, "segments", ["audio_path", "duration"])
    plan = R.cut_plan(S.number_occurrences(rows, ["audio_path"], "label", ["pos"]), settings.pad, settings.least_clip, keep_silence=settings.keep_silence)
    return plan.withColumn("clip", R.clip_name(F.col("audio_path"), F.col("label_numbered"), F.col("clip_start"), F.col("clip_end"), "flac"))


def songs_of_clips(clips: DataFrame, keys: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Clips with their keys (by clip; clips without go) and transcripts (empty where there are none), one array per song; repeated sides count once, the last one."""
    text = transcripts.select("clip", X.normalize_transcript(F.col("text")).alias("asr_text"), "ord")
    rows = J.attach_metadata(clips, keys, "clip", ["ord"])
    rows = J.attach_default(rows, J.last_wins(text, ["clip"], ["ord"]), "clip", "asr_text", F.lit(""))
    rows = rows.filter(F.lower("label") != "silence").withColumn("segment", F.col("label_numbered"))
    return G.segments_per_song(rows, "audio_path", "start", ["label_idx", "label"], ["segment", "label", "label_idx", "start", "end", "key", "clip", "asr_text"])


def clean(songs: DataFrame, limits: Q.Limits) -> tuple[DataFrame, DataFrame]:
    """(songs with bad transcripts mended, the bad segments). Segments are worked on as rows and grouped again."""
    rows = songs.select("audio_path", F.posexplode("song_structure_info").alias("pos", "s"))
    text, length = F.col("s.asr_text"), F.col("s.end") - F.col("s.start")
    rows = rows.withColumns({"repeat": Q.repeated_chunk(X.py_strip(text)), "raw": Q.repeated_chunk(text)})
    rows = rows.withColumn("reasons", Q.reasons(text, length, limits, F.col("repeat")))
    rows = rows.withColumn("fixed", Q.fixed(text, F.col("reasons"), F.col("raw")))
    bad = rows.filter(F.size("reasons") > 0).select("audio_path", F.col("pos").cast("long").alias("segment_index"), "reasons", Q.metrics(text, length, limits).alias("metrics"), text.alias("original_text"), F.col("fixed").alias("fixed_text"))
    item = F.struct("pos", F.col("s").withField("asr_text", F.col("fixed")).alias("s"))
    good = rows.groupBy("audio_path").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.to_json(item["s"]).alias("j")))), lambda x: x["j"]).alias("v"))
    kind = songs.schema["song_structure_info"].dataType.elementType.simpleString()
    good = good.select("audio_path", F.transform("v", lambda j: F.from_json(j, kind)).alias("song_structure_info"))
    return songs.drop("song_structure_info").join(good, "audio_path", "left"), bad


def transcribe(clips: DataFrame, models: Models, settings: Settings, previous: DataFrame | None = None, tag: bool = False) -> DataFrame:
    """(clip, text, error) of clips; those that ``previous`` (the same columns) has without an error aren't asked again, and the rows of both come back."""
    todo = clips.select("clip") if previous is None else J.remaining(clips.select("clip"), R.storable_rows(previous, ["error"]), ["clip"])
    said = run_backend(todo, models.transcript, "text STRING", batch=settings.batch, attempts=settings.attempts)
    said = said.withColumn("text", X.strip_language_tag(F.col("text"))) if tag else said
    return said if previous is None else said.unionByName(R.storable_rows(previous, ["error"]).select("clip", "text", "error"))


def first_captions(data: DataFrame, models: Models, settings: Settings) -> DataFrame:
    """``data`` with ``base_caption`` and its error."""
    return run_backend(data, models.caption, "base_caption STRING", error="caption_error", batch=settings.batch, attempts=settings.attempts)


def captions(songs: DataFrame, models: Models, settings: Settings, template: str = M.CAPTION_TEMPLATE) -> DataFrame:
    """Songs with the modes chosen by hash, the prompt of all that is known of them, and the caption; failed rows keep their error.

    Of the columns chords, beatnet, music_key, instruments_changes, lyrics and duration, and the descriptive ones, those that ``songs`` has are used.
    """
    import json

    key = F.col("audio_path")
    modes = {"language": (settings.language_weights, "en"), "style": (settings.style_weights, "paragraph"), "harmony_mode": (settings.harmony_weights, "basic")}
    rows = songs.withColumns({f"caption_{name}": H.weighted_choice(key, json.loads(weights), default, name) for name, (weights, default) in modes.items()})
    has = lambda c: F.col(c) if c in songs.columns else F.lit(None)
    part = lambda c, *fields: F.col(".".join((c, *fields))) if c in songs.columns else F.lit(None)
    none = F.array().cast("array<struct<chord:string,timestamp:double>>")
    spoken = F.exists("song_structure_info", lambda s: F.coalesce(s["asr_text"] != "", F.lit(False)))
    lyrics = has("lyrics").cast("string")
    hint = X.vocal_hint(F.coalesce(X.py_strip(lyrics) != "", F.lit(False)), F.coalesce(spoken, F.lit(False)), F.col("base_caption"))
    changes = M.instrument_lines(F.col("instruments_changes"), has("duration").cast("double")) if "instruments_changes" in songs.columns else F.lit(None)
    prompt = M.caption_prompt(
        key, has("duration"), F.col("base_caption"), M.segment_blocks(F.col("song_structure_info"), F.coalesce(part("chords", "values"), none) if "chords" in songs.columns else none), X.truncate(lyrics),
        part("beatnet", "max_beat_number"), part("beatnet", "bpm"), X.key_name(part("music_key", "key").cast("string"), part("music_key", "scale").cast("string")) if "music_key" in songs.columns else F.lit(None),
        changes, X.pretty_json(R.descriptive_json(songs)), hint, F.col("caption_language"), F.col("caption_style"), F.col("caption_harmony_mode"), hide_path=settings.hide_path, template=template,
    )
    asked = rows.withColumn("llm_merge_prompt", prompt).select("audio_path", *[f"caption_{m}" for m in modes], "llm_merge_prompt")
    said = run_backend(asked, models.final_caption, "caption STRING", batch=settings.batch, attempts=settings.attempts)
    scrubbed = X.scrub_output(F.col("caption"), settings.thinking)
    return said.withColumn("_s", scrubbed).withColumns({"caption": F.col("_s.text"), "error": F.coalesce("error", F.when(F.col("_s.status") != "ok", F.col("_s.status")))}).drop("_s")


def chats(said: DataFrame, source: str, models: Models, settings: Settings, fallback: list[str], template: str = M.QUERY_TEMPLATE) -> DataFrame:
    """Chat records of captions without error; a query that can't be parsed is replaced by one of the fallbacks, by hash."""
    stable = F.concat_ws(":", F.lit(source), F.col("audio_path"))
    rows = said.filter("error IS NULL").drop("error").withColumns({"query_length_class": H.length_class(stable, F.col("caption_style")), "query_seed": H.seed(stable)})
    prompt = M.filled(template, length=F.col("query_length_class"), language=F.upper("caption_language"), style=F.col("caption_style"), seed=F.col("query_seed"), caption=F.col("caption"))
    asked = run_backend(rows.withColumn("prompt", prompt), models.query, "answer STRING", batch=settings.batch, attempts=settings.attempts)
    query = F.coalesce(X.parse_prompt(F.col("answer")), H.pool_choice(stable, fallback, "fallback"))
    meta = F.struct(F.lit(source).alias("source_file"), "caption_style", "caption_language", "query_length_class", "query_seed")
    return asked.select(M.chat_record(query, F.col("caption"), F.col("audio_path"), meta).alias("c")).select("c.*")
