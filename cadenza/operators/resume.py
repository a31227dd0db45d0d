"""Resumable runs: what is done, what failed, what is next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.joins import last_wins, remaining
from cadenza.operators.partitioning import row_numbers


def latest(results: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last result per key, whatever came of it."""
    return last_wins(results, key, order)


def to_retry(inputs: DataFrame, results: DataFrame, key: list[str], order: list[str], success: Column) -> DataFrame:
    """Inputs whose latest result isn't a success: never run, or failed last."""
    return remaining(inputs, latest(results, key, order).filter(success), key)


def progress(log: DataFrame) -> DataFrame:
    """total (the last one announced), completed (distinct ids) and unallocated, from an append-only log of both kinds of record."""
    total = F.max_by("total_tasks", F.when(F.col("total_tasks").isNotNull(), F.col("timestamp")))
    done = F.count_distinct("task_id")
    return log.agg(F.coalesce(total, F.lit(0)).alias("total"), done.alias("completed")).withColumn("unallocated", F.greatest(F.col("total") - F.col("completed"), F.lit(0)))


def task_states(log: DataFrame, key: str, state: str, order: list[str], reset: str | None = None) -> DataFrame:
    """The latest state per task; a state of ``reset`` counts as unallocated."""
    out = last_wins(log.select(key, state, *order), [key], order).drop(*order)
    return out if reset is None else out.withColumn(state, F.when(F.col(state) == reset, "unallocated").otherwise(F.col(state)))


def next_tasks(tasks: DataFrame, done: DataFrame, key: str, n: int) -> DataFrame:
    """The first n tasks by key that aren't done."""
    return remaining(tasks, done, [key]).orderBy(key).limit(n)


def finished_shards(manifest: DataFrame, rows_in: str, rows_out: str) -> DataFrame:
    """Shards whose marker is there and whose output is whole."""
    return manifest.filter(F.col(rows_out) >= F.col(rows_in))


def watched(df: DataFrame, name: str, error: str) -> DataFrame:
    """``df`` with counters that listeners see as it is written: rows, ok, failed. No extra pass."""
    failed = F.coalesce(F.col(error) != "", F.lit(False))
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(~failed).alias("ok"), F.count_if(failed).alias("failed"))


def by_count(df: DataFrame, key: str, done: int, tie: list[str] | None = None) -> DataFrame:
    """Rows after the first ``done`` in order, for outputs without keys that only grow at their end; a key is the safer rule."""
    return row_numbers(df, key, tie).filter(F.col("rn") > done).drop("rn")


def resume_merge(inputs: DataFrame, stored: DataFrame, results: DataFrame, key: str, field: str) -> DataFrame:
    """Inputs with ``field``: what is stored stays as it is, the others take their result, null where there is none."""
    kept = stored.select(key, F.struct(F.col(field).alias("v")).alias("_stored"))
    new = results.select(key, F.col(field).alias("_new"))
    rows = inputs.drop(field).join(kept, key, "left").join(new, key, "left")
    return rows.withColumn(field, F.when(F.col("_stored").isNotNull(), F.col("_stored.v")).otherwise(F.col("_new"))).drop("_stored", "_new")


def allocate(spark: SparkSession, total: int, taken: DataFrame, key: str, cursor: int, n: int) -> DataFrame:
    """The next n free task ids (0 to ``total - 1``) from ``cursor`` on, and round to the ones before it; a top-n, nothing is sorted whole."""
    ahead = F.pmod(F.col(key) - F.lit(cursor), F.lit(max(total, 1)))
    return remaining(spark.range(total).withColumnRenamed("id", key), taken, [key]).withColumn("ahead", ahead).orderBy("ahead").limit(n)


def next_cursor(allocated: DataFrame, key: str, total: int, cursor: int) -> int:
    """Where the next call of ``allocate`` goes on."""
    last = allocated.agg(F.max_by(key, "ahead")).first()[0]
    return cursor if last is None else (last + 1) % total
