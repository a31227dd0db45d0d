"""Media files: scans by extension, object-store keys, shard paths, a reader registry."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.text import file_name, path_stem, path_suffix
from cadenza.operators.partitioning import ordered_slice, row_numbers
from cadenza.schemas import AUDIO_EXTENSIONS, VIDEO_EXTENSIONS


def scan_files(spark: SparkSession, path: str) -> DataFrame:
    """path and length of all files below; contents aren't read, as their column isn't asked for."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


def media_kind(path: Column) -> Column:
    """audio, video, or null for other and hidden files."""
    suffix = path_suffix(path)
    return F.when(file_name(path).startswith("."), None).when(suffix.isin(AUDIO_EXTENSIONS), "audio").when(suffix.isin(VIDEO_EXTENSIONS), "video")


def audio_target(path: Column) -> Column:
    """The file to probe: an audio file itself, for a video the mp3 beside it."""
    return F.when(media_kind(path) == "video", F.regexp_replace(path, r"\.[^./]+$", ".mp3")).otherwise(path)


def valid_duration(seconds: Column) -> Column:
    return seconds.isNotNull() & ~F.isnan(seconds) & (seconds > 0)


def rewrite_prefix(path: Column, old: str, new: str) -> Column:
    return F.when(path.startswith(old), F.concat(F.lit(new), F.substring(path, F.lit(len(old) + 1), F.length(path)))).otherwise(path)


def bucket_and_key(path: Column) -> Column:
    """struct<bucket, key> of ``scheme://bucket/key`` or ``bucket/key``."""
    bare = F.regexp_replace(path, r"^[A-Za-z0-9+.-]+://", "")
    return F.struct(F.regexp_extract(bare, r"^([^/]*)/(.+)$", 1).alias("bucket"), F.regexp_extract(bare, r"^([^/]*)/(.+)$", 2).alias("key"))


def valid_segment(start: Column, end: Column, subset: Column, oid: Column) -> Column:
    """Whether a segment row has all four parts it is joined by."""
    return start.isNotNull() & end.isNotNull() & subset.isNotNull() & oid.isNotNull()


def segments_with_metadata(segments: DataFrame, metadata: DataFrame) -> DataFrame:
    """Segment rows with their subset's metadata by (subset_name, oid); rows without go. Credentials never enter a row."""
    return segments.filter(valid_segment(*[F.col(c) for c in ("start", "end", "subset_name", "oid")])).join(metadata, ["subset_name", "oid"])


READERS: dict[str, Callable[..., DataFrame]] = {
    "parquet": lambda spark, path: spark.read.parquet(path),
    "json": lambda spark, path: spark.read.json(path),
    "files": scan_files,
}
ALIASES = {"jsonl": "json", "audio_jsonl": "json", "pq": "parquet", "columnar": "parquet", "dir": "files"}
#: The environment variable that names the reader where the caller names none.
READER_VARIABLE = "DATALOADER_TYPE"


def register_reader(name: str, read: Callable[..., DataFrame], *aliases: str) -> None:
    """Adds a source; ``read`` takes the session and a path."""
    READERS[name] = read
    ALIASES.update({a: name for a in aliases})


def open_reader(spark: SparkSession, kind: str | None, path: str, columns: list[str] | None = None, order: list[str] | None = None, offset: int = 0, limit: int | None = None, batch: int | None = None) -> DataFrame:
    """A source by its name or alias, or by the environment's. Columns are pruned in the scan. ``offset`` and ``limit`` count rows by ``order``;
    ``batch`` adds the number of each row's batch of so many rows, counted from the offset."""
    kind = kind or os.environ.get(READER_VARIABLE, "parquet")
    name = ALIASES.get(kind.lower(), kind.lower())
    if name not in READERS:
        raise ValueError(f"no reader named {kind}; there are {sorted(READERS)}")
    if (offset or limit is not None or batch) and not order:
        raise ValueError("offset, limit and batch need an order")
    rows = READERS[name](spark, path).select(*(columns or ["*"]))
    if limit is not None:
        rows = ordered_slice(rows, order[0], offset, limit, order[1:])
        offset = 0
    if offset or batch:
        rows = row_numbers(rows, order[0], order[1:]).filter(F.col("rn") > offset)
        rows = rows.withColumn("batch", F.floor((F.col("rn") - 1 - offset) / batch)) if batch else rows
        rows = rows.drop("rn")
    return rows.orderBy(*order) if order else rows


def verify_checksums(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """(name, md5, expected, ok) of files below ``path`` against a table of name and md5; a file that isn't there isn't ok."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(file_name(F.col("path")).alias("name"), F.md5("content").alias("md5"))
    return expected.withColumnRenamed("md5", "expected").join(found, "name", "left").withColumn("ok", F.coalesce(F.col("md5") == F.col("expected"), F.lit(False)))


def segment_files(spark: SparkSession, path: str, out: str, pattern: str = "segment*.jsonl") -> DataFrame:
    """(path, output_path, name) of the segment files below a folder, by name; an output lies below ``out`` under its input's name."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return rows.select("path", F.concat(F.lit(out.rstrip("/") + "/"), file_name(F.col("path"))).alias("output_path"), path_stem(F.col("path")).alias("name")).orderBy("name")
