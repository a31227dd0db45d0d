"""Sinks: JSON lines, Parquet, reject splits, manifests. Spark's commit protocol makes each write whole or absent."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StructType

from cadenza.functions.text import file_name
from cadenza.operators.joins import last_wins
from cadenza.storage import delete, exists, file_system, names_in, replace

# Columns that a record loses before it is stored.
TRANSIENT_COLUMNS = ["url", "audio_bytes", "audio_type"]


def _plain(c: Column, kind: DataType) -> Column | None:
    """``c`` without binary parts at any depth; None if nothing else is in it."""
    if isinstance(kind, BinaryType):
        return None
    if isinstance(kind, StructType):
        parts = [(f.name, _plain(c[f.name], f.dataType)) for f in kind.fields]
        kept = [p.alias(n) for n, p in parts if p is not None]
        return F.when(c.isNotNull(), F.struct(*kept)) if kept else None
    if isinstance(kind, ArrayType):
        return None if _plain(c, kind.elementType) is None else (F.transform(c, lambda x: _plain(x, kind.elementType)) if _has_bytes(kind) else c)
    if isinstance(kind, MapType):
        return None if _plain(c, kind.valueType) is None else (F.transform_values(c, lambda _, v: _plain(v, kind.valueType)) if _has_bytes(kind) else c)
    return c


def _has_bytes(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_bytes(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _has_bytes(kind.elementType)
    return _has_bytes(kind.valueType) if isinstance(kind, MapType) else isinstance(kind, BinaryType)


def without_bytes(df: DataFrame) -> DataFrame:
    """Without binary values, however deep in structs, arrays and maps; worked out from the schema alone."""
    parts = [(f, _plain(F.col(f"`{f.name}`"), f.dataType) if _has_bytes(f.dataType) else F.col(f"`{f.name}`")) for f in df.schema.fields]
    return df.select(*[c.alias(f.name) for f, c in parts if c is not None])


def storable(df: DataFrame) -> DataFrame:
    """Without transient columns, without bytes at any depth, and without credentials."""
    return without_bytes(df.drop(*TRANSIENT_COLUMNS, "access_key", "secret_key"))


def write_jsonl(df: DataFrame, path: str, mode: str = "append", by: list[str] | None = None) -> None:
    out = storable(df).write.mode(mode)
    (out.partitionBy(*by) if by else out).json(path)


def split_write(df: DataFrame, error: Column, good: str, bad: str) -> None:
    """Rows without an error to one place, rows with one to another."""
    failed = F.coalesce(error != "", F.lit(False))
    write_jsonl(df.filter(~failed), good)
    write_jsonl(df.filter(failed), bad)


def bad_segments(songs: DataFrame, segments: str, reasons: str) -> DataFrame:
    """One row per segment that has reasons, with its index."""
    rows = songs.select("audio_path", F.posexplode(segments).alias("segment_index", "s")).select("audio_path", F.col("segment_index").cast("long").alias("segment_index"), "s.*")
    return rows.filter(F.size(reasons) > 0)


def write_manifest(df: DataFrame, path: str, shard: Column) -> None:
    """Rows per shard, written after the data: a shard counts as done once it is listed."""
    df.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)


def rewrite(df: DataFrame, path: str) -> None:
    """``df`` in the place of what ``path`` holds (which it may read): written beside it, then renamed."""
    staged = f"{path}.new-{uuid.uuid4().hex[:8]}"
    df.write.parquet(staged)
    replace(df.sparkSession, staged, path)


def snapshot(updates: DataFrame, path: str, key: list[str], order: list[str]) -> None:
    """Stored records with ``updates`` over them: the last one per key stays, in one rewrite."""
    spark = updates.sparkSession
    rows = spark.read.parquet(path).unionByName(updates, allowMissingColumns=True) if exists(spark, path) else updates
    rewrite(last_wins(rows, key, order), path)


def run_in_lots(df: DataFrame, step: Callable[[DataFrame], DataFrame], path: str, key: list[str], order: list[str], lots: int) -> None:
    """``step`` over ``lots`` parts of ``df`` by key, with a snapshot after each, so that a run that ends early loses one lot at most."""
    for i in range(lots):
        snapshot(step(df.filter(F.pmod(F.xxhash64(*key), F.lit(lots)) == i)), path, key, order)


def output_targets(names: list[str], output: str, is_folder: bool) -> tuple[dict[str, str], str]:
    """(where each input's rows go, where failures go): one ``.jsonl`` for a single input, else a folder with the inputs' names."""
    if not is_folder and len(names) == 1 and output.endswith(".jsonl"):
        return {names[0]: output}, f"{output}.failed.log"
    if not is_folder and output.endswith(".jsonl"):
        raise ValueError(f"several inputs need a folder: {output}")
    base = output.rstrip("/")
    return {n: f"{base}/{n}" for n in names}, f"{base}/failed_records.log"


def write_by_source(df: DataFrame, source: Column, out: str) -> None:
    """JSON lines below ``out`` under the names of the files that rows come from: one shuffle-free write, then a rename a name."""
    spark, staged = df.sparkSession, f"{out.rstrip('/')}/_staged-{uuid.uuid4().hex[:8]}"
    storable(df).withColumn("_name", F.coalesce(file_name(source), F.lit("unnamed"))).write.partitionBy("_name").json(staged)
    for name in [n for n in names_in(spark, staged) if n.startswith("_name=")]:
        from urllib.parse import unquote

        replace(spark, f"{staged}/{name}", f"{out.rstrip('/')}/{unquote(name.removeprefix('_name='))}")
    delete(spark, staged)


def mark_done(spark: SparkSession, path: str) -> None:
    """Puts the marker of a whole output into a folder."""
    fs, where = file_system(spark, f"{path}/_SUCCESS")
    fs.create(where, True).close()


def is_done(spark: SparkSession, path: str) -> bool:
    """Whether a folder has the marker and something besides that isn't empty."""
    fs, where = file_system(spark, path)
    if not fs.exists(where) or "_SUCCESS" not in names_in(spark, path):
        return False
    return any(f.getLen() > 0 and not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(where))


def step(spark: SparkSession, path: str, make: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """The table at ``path``: made and written unless a whole one that isn't empty is there."""
    if force or not is_done(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
