"""String expressions: transcripts, model output, clocks, paths and URLs. All are Column -> Column."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Transcripts that mean "no lyrics".
NO_LYRICS = ["NO_LYRICS_DETECTED", "NO_LYRIC_DETECTED", "NO ASR RESULT", "NO_ASR_RESULT", "[inaudible]", "[INAUDIBLE]", "inaudible", "INAUDIBLE", "[Inaudible]"]
# Marks of hidden reasoning in model output, in lower case.
LEAK_MARKS = ["<think>", "</think>", "here's a thinking process:"]
# Words of a description that speak for vocals; they count inside other words too.
VOCAL_WORDS = ["vocal", "singer", "singing", "lyric", "rap", "ballad", "verse", "chorus", "hook"]

# The code points that ``str.strip`` takes off.
BLANKS = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def py_strip(c: Column) -> Column:
    return F.btrim(c, F.lit("".join(map(chr, BLANKS))))


def normalize_transcript(c: Column) -> Column:
    """Stripped text; null, blank and the "no lyrics" tokens become the empty string."""
    text = py_strip(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(text.isin(NO_LYRICS), "").otherwise(text)


def strip_language_tag(c: Column) -> Column:
    """Without a leading ``<|tag|>``."""
    return F.regexp_replace(c, r"^<\|[a-z_]+\|>\s*", "")


def has_long_run(c: Column, run: int) -> Column:
    """Some character (not a newline) comes more than ``run`` times in a row."""
    return c.rlike(r"(.)\1{%d,}" % run)


def chars_per_second(text: Column, duration: Column) -> Column:
    return F.length(py_strip(text)) / F.greatest(duration, F.lit(1e-3))


@pandas_udf(StructType([StructField(n, LongType()) for n in ("length", "distinct", "most")]))
def char_profile(texts: pd.Series) -> pd.DataFrame:
    """Of each stripped text: how many characters, how many distinct ones, and how often the most frequent one comes; an Arrow batch at a time, as an array of characters in
    SQL costs a string each."""
    out = np.zeros((len(texts), 3), dtype=np.int64)
    for i, text in enumerate(texts):
        if text is not None and (text := text.strip()):
            if text.isascii():
                n = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8))
                out[i] = len(text), np.count_nonzero(n), n.max()
            else:
                n = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), return_counts=True)[1]
                out[i] = len(text), len(n), n.max()
    return pd.DataFrame(out, columns=["length", "distinct", "most"])


def unique_char_ratio(profile: Column) -> Column:
    """Distinct characters over all, of a ``char_profile``; 1 for blank text."""
    return F.when(profile["length"] == 0, F.lit(1.0)).otherwise(profile["distinct"] / profile["length"])


def max_char_ratio(profile: Column) -> Column:
    """Share of the most frequent character, of a ``char_profile``; 0 for blank text."""
    return F.when(profile["length"] == 0, F.lit(0.0)).otherwise(profile["most"] / profile["length"])


def scrub_output(c: Column, thinking: bool) -> Column:
    """struct(status, text): model output without hidden reasoning; status is ok, leak or empty, and text is null unless ok."""
    text = py_strip(F.coalesce(c, F.lit("")))
    if thinking:
        text = py_strip(F.regexp_replace(text, r"(?is)<think>.*?</think>", ""))
    low = F.lower(text)
    leak = F.lit(False)
    for mark in LEAK_MARKS:
        leak = leak | low.contains(mark)
    status = F.when(leak, "leak").when(text == "", "empty").otherwise("ok")
    return F.struct(status.alias("status"), F.when(status == "ok", text).alias("text"))


def parse_prompt(c: Column) -> Column:
    """The stripped ``prompt`` string of a JSON object, or of the outermost braces of other text; null where there is none."""
    body = py_strip(c)
    inner = F.regexp_extract(body, r"(?s)(\{.*\})", 1)

    def prompt(json: Column) -> Column:
        found = F.try_variant_get(F.try_parse_json(json), "$.prompt", "string")
        return F.when(F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), "$.prompt", "variant")) == "STRING", found)

    found = py_strip(F.coalesce(prompt(body), prompt(inner)))
    return F.when(found != "", found)


def normalize_style(c: Column) -> Column:
    """``sections`` or ``paragraph``."""
    return F.when(F.lower(py_strip(F.coalesce(c, F.lit("")))) == "sections", "sections").otherwise("paragraph")


def normalize_language(c: Column) -> Column:
    """``zh`` or ``en``."""
    return F.when(F.lower(py_strip(F.coalesce(c, F.lit("")))).startswith("zh"), "zh").otherwise("en")


def vocal_hint(has_reference: Column, has_transcript: Column, description: Column) -> Column:
    """``reference``, ``likely`` or an empty string: what a prompt says about vocals."""
    low = F.lower(F.coalesce(description, F.lit("")))
    likely = F.lit(False)
    for word in VOCAL_WORDS:
        likely = likely | low.contains(word)
    return F.when(has_reference, "reference").when(has_transcript, "").when(likely, "likely").otherwise("")


def truncate(c: Column, limit: int = 2000, mark: str = "\n[...truncated]") -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(mark))).otherwise(c)


def clock_to_seconds(c: Column) -> Column:
    """Seconds of the first ``hh:mm:ss.mmm``; null where there is none."""
    part = lambda i: F.regexp_extract(c, r"(\d{2}):(\d{2}):(\d{2}\.\d{3})", i)
    return F.when(part(3) != "", part(1).cast("int") * 3600 + part(2).cast("int") * 60 + part(3).cast("double"))


def seconds_to_clock(c: Column) -> Column:
    """``hh:mm:ss`` of seconds rounded half to even, not below zero."""
    s = F.greatest(F.bround(c.cast("double")), F.lit(0.0)).cast("long")
    two = lambda x: F.when(x < 100, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))
    return F.concat_ws(":", two(F.floor(s / 3600)), two(F.floor(s / 60) % 60), two(s % 60))


def fixed3(c: Column) -> Column:
    """Three decimals, or N/A."""
    return F.when(c.isNull(), "N/A").otherwise(F.format_string("%.3f", c.cast("double")))


def key_name(key: Column, scale: Column) -> Column:
    """``key scale``, the key alone, or N/A."""
    has = lambda x: x.isNotNull() & (x != "")
    return F.when(has(key) & has(scale), F.concat_ws(" ", key, scale)).when(has(key), key).otherwise("N/A")


def is_url(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?i)^https?://"), F.lit(False))


def media_url(c: Column) -> Column:
    """URLs as they are, absolute paths as ``file://`` URLs."""
    return F.when(is_url(c) | c.startswith("file://"), c).otherwise(F.concat(F.lit("file://"), c))


def host_of(c: Column) -> Column:
    """The host (and port) of an endpoint, with or without a scheme."""
    return F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/]*)", 1)


def file_name(c: Column) -> Column:
    return F.regexp_extract(c, r"([^/]*)$", 1)


def path_suffix(c: Column) -> Column:
    """The extension with its dot in lower case; empty for dot files and names that end with a dot."""
    return F.lower(F.regexp_extract(file_name(c), r"[^/.][^/]*?(\.[^./]+)$", 1))


def path_stem(c: Column) -> Column:
    """The file name without its extension."""
    name = file_name(c)
    return F.substring(name, F.lit(1), F.length(name) - F.length(path_suffix(c)))


def path_parent(c: Column) -> Column:
    return F.regexp_extract(c, r"^(.*)/[^/]*$", 1)


@pandas_udf(StringType())
def pretty_json(texts: pd.Series) -> pd.Series:
    """JSON text with an indent of two spaces and characters beyond ASCII as they are; other text stays."""
    def pretty(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(json.loads(text), ensure_ascii=False, indent=2)
        except ValueError:
            return text

    return texts.map(pretty)


def safe_label(c: Column) -> Column:
    """A label fit for a file name: slashes, backslashes and spaces become underscores."""
    return F.translate(c, "/\\ ", "___")


def line_uid(c: Column) -> Column:
    """A line number as nine digits."""
    return F.lpad(c.cast("string"), 9, "0")
