"""JSON lines: discovery, typed reads with a quarantine, strict reads, path fallbacks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.reshape import first_present

# The fields that may hold a record's path, in order.
RECORD_PATHS = ["audio_path", "url", "path", "file"]
AUDIO_PATHS = ["audio_path", "prompt", "path", "file"]


def read_lines(spark: SparkSession, paths: str | list[str], recursive: bool = True, without: str | None = None) -> DataFrame:
    """(source, line) of all ``*.jsonl`` below the paths but the file ``without`` (an output among the inputs); blank lines go."""
    rows = spark.read.option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", "*.jsonl").text(paths)
    lines = rows.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("line")).filter(F.trim("line") != "")
    return lines if without is None else lines.filter(~F.col("source").endswith(without))


def discover(spark: SparkSession, paths: list[str], pattern: str = "*.jsonl", recursive: bool = True) -> DataFrame:
    """(path) of the files that the paths (files or folders) hold, each once, in order; contents aren't read."""
    found = [spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", pattern).load(p).select("path") for p in dict.fromkeys(paths)]
    return reduce(DataFrame.union, found).distinct().orderBy("path")


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """(records with their source, quarantine): lines that aren't a JSON object go to the quarantine as they are."""
    lines = read_lines(spark, paths)
    parsed = lines.withColumn("record", F.from_json("line", schema + ", _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    good = F.try_parse_json("line").isNotNull() & F.col("line").rlike(r"^\s*\{")
    return parsed.filter(good).select("source", "record.*").drop("_corrupt"), lines.filter(~good)


def read_jsonl_strict(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Records; the first line that isn't a JSON object fails the job with its file."""
    lines = read_lines(spark, paths)
    good = F.try_parse_json("line").isNotNull() & F.col("line").rlike(r"^\s*\{")
    checked = lines.withColumn("line", F.when(good, F.col("line")).otherwise(F.raise_error(F.concat(F.lit("not a JSON object in "), F.col("source"), F.lit(": "), F.substring("line", 1, 200)))))
    return checked.select("source", F.from_json("line", schema).alias("record")).select("source", "record.*")


def record_path(record: Column, keys: list[str] = RECORD_PATHS) -> Column:
    """The path of a map<string,string> record: the first key that is there, even if its value is null."""
    return first_present(record, keys)


def has_location(path: Column, url: Column, content: Column, bucket: Column, key: Column) -> Column:
    """Whether a record says where its audio is."""
    filled = lambda c: F.coalesce(c != "", F.lit(False))
    return filled(path) | filled(url) | content.isNotNull() | (filled(bucket) & filled(key))


def known_and_rest(df: DataFrame, known: list[str]) -> DataFrame:
    """Known columns, and all others as one JSON object without nulls (``extra``); binary columns go."""
    kinds = dict(df.dtypes)
    rest = [c for c in df.columns if c not in known and kinds[c] != "binary"]
    return df.select(*[c for c in known if c in kinds and kinds[c] != "binary"], F.to_json(F.struct(*rest)).alias("extra") if rest else F.lit("{}").alias("extra"))
