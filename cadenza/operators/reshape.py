"""Record reshaping: cut plans, flattening, defaults, old formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import path_stem, py_strip, safe_label
from cadenza.operators.joins import match_overlaps_in_row
from cadenza.schemas import TEMPORARY_COLUMNS


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor the empty string."""
    return F.coalesce(*[F.when(c != "", c) for c in columns])


def first_present(record: Column, keys: list[str]) -> Column:
    """The value (null too) of the first key that a map has."""
    out = F.lit(None).cast("string")
    for k in reversed(keys):
        out = F.when(F.map_contains_key(record, k), record[k]).otherwise(out)
    return out


def duration_of(duration: Column, seconds: Column, segments: Column) -> Column:
    """The duration, its other name, or the last segment's end; 0 counts as missing for the first two."""
    real = lambda c: F.when(c.cast("double") != 0, c.cast("double"))
    return F.coalesce(real(duration), real(seconds), F.try_element_at(segments, F.lit(-1))["end"] if segments is not None else F.lit(None))


def padded_interval(start: Column, end: Column, total: Column, pad: float) -> tuple[Column, Column]:
    """An interval widened by ``pad`` on both sides within [0, total]."""
    inside = lambda x: F.greatest(F.lit(0.0), F.least(total, x))
    return inside(start - pad), inside(end + pad)


def cut_plan(segments: DataFrame, pad: float = 0.0, least: float = 0.2, total: str = "duration", label: str = "label", keep_silence: bool = False) -> DataFrame:
    """Clips of numbered segments: clamped and padded, without silence (unless kept) and without those shorter than ``least``."""
    s, e = padded_interval(F.col("start"), F.col("end"), F.col(total), pad)
    rows = segments if keep_silence else segments.filter(F.lower(label) != "silence")
    return rows.withColumns({"clip_start": s, "clip_end": e}).filter((F.col("clip_end") > F.col("clip_start")) & (F.col("clip_end") - F.col("clip_start") >= least))


def clip_name(path: Column, label: Column, start: Column, end: Column, suffix: str) -> Column:
    """``stem__label_start_end-hash.suffix``: a hash of the whole path keeps songs of one name apart."""
    return F.concat(path_stem(path), F.lit("__"), safe_label(label), F.format_string("_%.3f_%.3f-", start, end), F.substring(F.md5(path), 1, 8), F.lit("." + suffix))


def segments_of(songs: DataFrame, segments: str, keep: list[str]) -> DataFrame:
    """One row per segment, with its position."""
    return songs.select(*keep, F.posexplode(segments).alias("pos", "segment")).select(*keep, "pos", "segment.*")


def without_labels(df: DataFrame, label: str, skip: list[str]) -> DataFrame:
    """Rows whose label isn't one of ``skip``, in any case; a null label stays."""
    return df.filter(~F.coalesce(F.lower(label).isin([s.lower() for s in skip]), F.lit(False)))


def chord_progression(values: Column, none: str = "N") -> Column:
    """struct<values, progression>: the chords but ``none`` ("no chord"), and their names in order."""
    kept = F.filter(values, lambda c: F.coalesce(c["chord"] != none, F.lit(True)))
    return F.struct(kept.alias("values"), F.transform(kept, lambda c: c["chord"]).alias("progression"))


def storable_rows(df: DataFrame, errors: list[str]) -> DataFrame:
    """Rows without any error: a failed row is neither stored nor counted as done."""
    for error in errors:
        df = df.filter(F.coalesce(F.col(error) == "", F.lit(True)))
    return df


def with_default_text(segments: Column) -> Column:
    """Every segment with an ``asr_text``; a null stays null only where the field was there before."""
    return F.transform(segments, lambda s: s.withField("asr_text", F.coalesce(s["asr_text"], F.lit(""))))


def flatten_analysis(df: DataFrame) -> DataFrame:
    """music_cpu and music_gpu as chords, beatnet, music_key and instruments_changes; temporary columns and those that begin with an underscore go."""
    fields = {"chords": ("music_cpu", "chords"), "beatnet": ("music_cpu", "beatnet"), "music_key": ("music_cpu", "key"), "instruments_changes": ("music_gpu", "changes")}
    new = {name: F.col(outer)[inner] for name, (outer, inner) in fields.items() if outer in df.columns and inner in df.schema[outer].dataType.names}
    out = df.withColumns(new).drop("music_cpu", "music_gpu", *TEMPORARY_COLUMNS)
    out = out.drop(*[c for c in out.columns if c.startswith("_")])
    first = [c for c in ("audio_path", "song_structure_info") if c in out.columns]
    return out.select(*first, *[c for c in out.columns if c not in first])


def parse_blocks(text: Column) -> Column:
    """array<struct<label, start, end, text>> of a transcript in blocks: ``[label] [hh:mm:ss.mmm]``, lines, ``[hh:mm:ss.mmm]``.

    Lines are classed, and each label line takes the lines up to the next label or clock line. A block without an end
    takes the start of the next.
    """
    head, clock = r"^\[([^\]]+)\]\s*\[(\d{2}):(\d{2}):(\d{2}\.\d{3})\]\s*$", r"^\[(\d{2}):(\d{2}):(\d{2}\.\d{3})\]$"
    seconds = lambda x, p, i: F.regexp_extract(x, p, i).cast("int") * 3600 + F.regexp_extract(x, p, i + 1).cast("int") * 60 + F.regexp_extract(x, p, i + 2).cast("double")
    kind = lambda x: F.when(x.rlike(head), "h").when(x.rlike(clock), "c").when(x != "", "t").otherwise("e")
    lines = F.transform(F.split(text, r"\r\n|\r|\n"), lambda x: F.struct(kind(py_strip(x)).alias("k"), py_strip(x).alias("x")))
    lines = F.element_at(F.transform(F.array(lines), lambda v: F.transform(v, lambda s, i: F.struct(s["k"].alias("k"), s["x"].alias("x"), i.alias("i")))), 1)

    def blocks(v: Column) -> Column:
        heads = F.filter(v, lambda s: s["k"] == "h")

        def block(h: Column) -> Column:
            stop = F.get(F.filter(v, lambda s: (s["i"] > h["i"]) & s["k"].isin("h", "c")), F.lit(0))
            words = F.filter(v, lambda s: (s["i"] > h["i"]) & (s["k"] == "t") & (stop.isNull() | (s["i"] < stop["i"])))
            end = F.when(stop["k"] == "c", seconds(stop["x"], clock, 1)).when(stop["k"] == "h", seconds(stop["x"], head, 2))
            return F.struct(py_strip(F.regexp_extract(h["x"], head, 1)).alias("label"), seconds(h["x"], head, 2).cast("double").alias("start"), end.cast("double").alias("end"), F.array_join(F.transform(words, lambda s: s["x"]), "\n").alias("text"))

        return F.transform(heads, block)

    return F.element_at(F.transform(F.array(lines), blocks), 1)


def segments_of_old_format(key_change: Column, transcript: Column, least: float = 0.02) -> Column:
    """Segments from key changes with the transcript's blocks laid over them; without a transcript the texts are empty."""
    empty = F.transform(key_change, lambda s: s.withField("asr_text", F.lit("")))
    return F.when(py_strip(F.coalesce(transcript, F.lit(""))) != "", match_overlaps_in_row(key_change, parse_blocks(transcript), least)).otherwise(empty)


# Descriptive columns that a prompt may use, and those of the resolved metadata.
DESCRIPTIVE = ["title", "artist", "genre_top", "genres", "genres_all", "name", "artist_name", "music_tags", "mtg_genres", "mtg_instruments", "mtg_moodthemes", "mtg_top50", "musicinfo"]
RESOLVED = ["genres", "moods"]


def descriptive_json(df: DataFrame, resolved: str = "resolved_music_metadata") -> Column:
    """The descriptive columns that ``df`` has as one JSON object without nulls; resolved values take their place where they are filled."""
    parts = {c: F.col(c) for c in DESCRIPTIVE if c in df.columns}
    if resolved in df.columns:
        for c in RESOLVED:
            if c in df.schema[resolved].dataType.names:
                value = F.col(resolved)[c]
                parts[c] = F.coalesce(F.when(F.size(value) > 0, value), parts[c]) if c in parts else F.when(F.size(value) > 0, value)
    return F.to_json(F.struct(*[v.alias(k) for k, v in parts.items()])) if parts else F.lit("{}")


def mirrored_dir(path: Column, root: str, out: str) -> Column:
    """The folder below ``out`` that mirrors a path's folder below ``root``; ``out`` itself for paths elsewhere."""
    base = root.rstrip("/") + "/"
    parent = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    inside = F.substring(parent, F.lit(len(base) + 1), F.length(parent))
    return F.when(path.startswith(base) & (inside != ""), F.concat(F.lit(out.rstrip("/") + "/"), inside)).otherwise(F.lit(out.rstrip("/")))
