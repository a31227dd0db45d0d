"""Prompts and chat records. Templates are parameters; the defaults are this engine's own wording."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza.functions.arrays import compact_repeats
from cadenza.functions.text import fixed3, key_name, py_strip

CAPTION_TEMPLATE = (
    "Describe one recording for a listener who can't hear it yet.\n\n{path}length in seconds:\n{duration}\n\nfirst description:\n{caption}\n\n{segments}{lyrics}{beats}{tempo}{key}{instruments}"
    "more:\n{metadata}\n\n{hint}\n\nUse what is given, trust the first description where parts disagree, name no source and no field.\n\n{language}\n{style}\n{harmony}\n\nAnswer with the description alone.\n"
)
LANGUAGE_RULES = {"en": "Write in English; quote lyrics as they are.", "zh": "Write in Chinese; quote lyrics as they are."}
STYLE_RULES = {"paragraph": "Write one paragraph.", "sections": "Write one part for each section of the song, with its times."}
HARMONY_RULES = {"basic": "", "degree": "Name chords by their degrees in the key."}
HINTS = {"reference": "The lyrics given are the song's own.", "likely": "There may be a voice though no words were found.", "": ""}
QUERY_TEMPLATE = "Write one {length} request in {language} that a description in the form of {style} would answer. Seed {seed}.\nDescription: {caption}\nAnswer as JSON with the field prompt.\n"


def chords_between(values: Column, start: Column, end: Column) -> Column:
    """The chords with start <= timestamp < end, without repeats next to each other."""
    inside = F.filter(values, lambda c: (c["timestamp"] >= start) & (c["timestamp"] < end) & (c["chord"] != ""))
    return compact_repeats(F.transform(inside, lambda c: c["chord"]))


def segment_blocks(segments: Column, chords: Column, skip: list[str] | None = None) -> Column:
    """One text block per segment: name, start, key, lyrics, chords, end."""
    kept = F.filter(segments, lambda s: ~F.coalesce(s["label"], F.lit("")).isin(skip)) if skip else segments

    def block(s: Column) -> Column:
        lyrics = py_strip(F.coalesce(s["asr_text"], F.lit("")))
        line = F.array_join(chords_between(chords, s["start"], s["end"]), " ")
        name = F.coalesce(F.when(s["segment"] != "", s["segment"]), F.when(s["label"] != "", s["label"]), F.lit("segment"))
        return F.concat(F.lit("["), name, F.lit("] ["), fixed3(s["start"]), F.lit("] ["), key_name(s["key"]["key"], s["key"]["scale"]), F.lit("]\nlyrics:\n"), F.when(lyrics != "", lyrics).otherwise("(none)"), F.lit("\n\nchord_progression:\n"), F.when(F.coalesce(line, F.lit("")) != "", line).otherwise("N/A"), F.lit("\n["), fixed3(s["end"]), F.lit("]\n"))

    return F.coalesce(F.array_join(F.transform(kept, block), "\n"), F.lit(""))


def filled(template: str, **slots: Column) -> Column:
    """A template with its ``{name}`` slots filled; text that a slot brings in is not searched again."""
    parts: list[Column] = []
    rest = template
    while rest:
        at = min(((rest.find("{" + k + "}"), k) for k in slots if "{" + k + "}" in rest), default=None)
        if at is None:
            parts.append(F.lit(rest))
            break
        place, name = at
        parts += [F.lit(rest[:place]), F.coalesce(slots[name].cast("string"), F.lit(""))]
        rest = rest[place + len(name) + 2 :]
    return F.concat(*parts)


def chat_record(query: Column, answer: Column, audio: Column, meta: Column) -> Column:
    """struct<messages, audios, meta> of one training record."""
    said = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.struct(F.array(said("user", F.concat(F.lit("<audio>"), query)), said("assistant", answer)).alias("messages"), F.array(audio).alias("audios"), meta.alias("meta"))


def _section(title: str, body: Column) -> Column:
    """A titled section, or nothing for a null or empty body."""
    text = body.cast("string")
    return F.when(F.coalesce(text != "", F.lit(False)), F.concat(F.lit(title + ":\n"), text, F.lit("\n\n"))).otherwise("")


def _rule(rules: dict[str, str], mode: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]), mode)


def instrument_lines(changes: Column, duration: Column) -> Column:
    """One line per span of instruments: ``[start - end] names``; a change lasts to the next one, or to the end."""
    def line(c: Column, i: Column) -> Column:
        end = F.coalesce(F.get(changes, i + 1)["time"], duration, c["time"])
        return F.when(F.size(c["active"]) > 0, F.concat(F.lit("["), fixed3(c["time"]), F.lit(" - "), fixed3(end), F.lit("] "), F.array_join(c["active"], ", ")))

    return F.array_join(F.array_compact(F.transform(changes, line)), "\n")


def caption_prompt(path: Column, duration: Column, caption: Column, segments: Column, lyrics: Column, beats: Column, bpm: Column, key: Column, instruments: Column, metadata: Column, hint: Column, language: Column, style: Column, harmony: Column, hide_path: bool = False, template: str = CAPTION_TEMPLATE) -> Column:
    """The whole prompt of a recording; a part that is null or empty has no section."""
    return filled(
        template,
        path=F.lit("") if hide_path else _section("path", F.coalesce(path, F.lit("N/A"))),
        duration=F.coalesce(F.format_string("%.6f", duration.cast("double")), F.lit("N/A")) if duration is not None else F.lit("N/A"),
        caption=F.when(F.coalesce(caption != "", F.lit(False)), caption).otherwise("N/A"),
        segments=_section("sections with key, lyrics and chords", segments),
        lyrics=_section("lyrics", lyrics),
        beats=_section("beats in a bar", beats),
        tempo=_section("tempo in BPM", bpm),
        key=_section("key", key),
        instruments=_section("instruments", instruments),
        metadata=F.coalesce(metadata, F.lit("{}")),
        hint=_rule(HINTS, F.coalesce(hint, F.lit(""))),
        language=_rule(LANGUAGE_RULES, language),
        style=_rule(STYLE_RULES, style),
        harmony=_rule(HARMONY_RULES, harmony),
    )
