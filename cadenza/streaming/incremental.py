"""Incremental runs: files that land are worked on once, by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cadenza.storage import exists


def run_new(spark: SparkSession, landing: str, schema: StructType | str, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: list[str], fmt: str = "json") -> StreamingQuery:
    """Applies ``step`` to what has landed since the last run and appends rows whose key isn't stored yet.

    The checkpoint says which files were taken; the anti-join on the key makes a batch that is run again harmless.
    """
    def store(batch: DataFrame, _: int) -> None:
        done = step(batch).dropDuplicates(key)
        if exists(spark, out):
            done = done.join(spark.read.parquet(out).select(*key), key, "left_anti")
        done.write.mode("append").parquet(out)

    query = spark.readStream.schema(schema).format(fmt).load(landing).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
