"""Named queries with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; ``{events}`` in its SQL stands for the events as segments."""
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql.replace("{events}", "(SELECT event_id, user_id AS song, event_type AS label, epoch_us(ts) AS us, epoch_us(ts) / 1e6 AS t, value FROM events)")
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the segments of a song: event_id, song, label, us (microseconds), t (seconds), value."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("song"), F.col("event_type").alias("label"), us.alias("us"), (us / F.lit(1e6)).alias("t"), "value")
