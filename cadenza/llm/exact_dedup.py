"""Exact deduplication by stateful streaming.

Documents land as (digest, id, locator) rows. A streaming aggregation with a RocksDB state store
keeps, per digest and without expiry, the largest id, the locator of its content and a count; a rerun
with the same folders takes only rows that landed since. Where a digest was hit more than once
the full bytes are compared. The scan lets through only texts whose digest a bitmap of the hit ones knows (of fixed size; a full
one lets all through, which costs time and changes nothing); they are grouped by (digest, text), so each map task
has compared its own rows before it hands on one text a group. Two texts of one digest (a collision) become two groups.

Defined results: null text is the empty text; a null id loses against any other and is never kept
unless the whole group has none; every input row gives one output row, repeated rows too (a repeated
row counts in ``group_size``, and rows that share the staying id all stay); no rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.bitmaps import bitmap, contains
from cadenza.llm.common import HOT_SHARE, Scratch, id_and_text, salted_join
from cadenza.llm.words import U64

LANDED = "digest string, doc_id long, locator string, n_bytes long"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # files as large as their content: by default each state partition sets some megabytes aside on disk
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def digest_of(text: Column) -> Column:
    return F.sha2(text, 256)


def land(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Appends the digest rows of ``docs`` to the landing table at ``path``."""
    rows = id_and_text(docs, id_col, text_col).select(
        digest_of(F.col("text")).alias("digest"), "doc_id", F.input_file_name().alias("locator"), F.octet_length("text").cast("long").alias("n_bytes")
    )
    rows.write.mode("append").parquet(path)


def advance(spark: SparkSession, landing: str, checkpoint: str) -> None:
    """Feeds what has landed since the last call to the keyed state kept under ``checkpoint``."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        seen = (
            spark.readStream.schema(LANDED).parquet(landing)
            .groupBy("digest")
            .agg(F.max(F.struct("doc_id", "locator")).alias("newest"), F.count(F.lit(1)).alias("copies"))
        )
        query = seen.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keyed state: digest, keep_id, locator, copies."""
    rows = spark.read.format("statestore").load(checkpoint)
    newest, copies = rows.schema["value"].dataType.names
    return rows.select(F.col("key.digest").alias("digest"), F.col(f"value.{newest}.doc_id").alias("keep_id"), F.col(f"value.{newest}.locator").alias("locator"), F.col(f"value.{copies}").alias("copies"))


def _hits(texts: DataFrame, shared: Broadcast) -> DataFrame:
    """The rows of ``texts`` (digest, doc_id, text) whose digest a bitmap knows; nothing is shuffled."""
    def let_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = contains(shared.value, batch.column("key").to_numpy().view(U64))
            if known.any():
                yield batch.filter(pa.array(known))

    return texts.withColumn("key", F.xxhash64("digest")).mapInArrow(let_through, "digest string, doc_id long, text string, key long").drop("key")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, locator."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    land(docs, scratch.dir("landing"), id_col, text_col)
    landed = spark.read.schema(LANDED).parquet(scratch.dir("landing"))
    total = landed.count()
    if not total:
        return landed.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("digest").alias("text_sha256"), "locator")
    advance(spark, scratch.dir("landing"), scratch.dir("state"))
    known = scratch.table(state(spark, scratch.dir("state")), "known")
    scratch.drop("state")
    hot = known.filter(F.col("copies") * HOT_SHARE >= total).filter("copies > 1").select("digest")

    # the full bytes of every hit: one group a text, however many of the digest
    texts = id_and_text(docs, id_col, text_col).select(digest_of(F.col("text")).alias("digest"), "doc_id", "text")
    twice = known.filter("copies > 1").select("digest")
    shared = spark.sparkContext.broadcast(bitmap(twice.select(F.xxhash64("digest").alias("key"))))
    groups = _hits(texts, shared).groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    text_key = F.sha2(F.concat(F.lit("other"), F.col("text")), 512).alias("text_key")
    proven = scratch.table(groups.select("digest", text_key, "keep_id", "group_size"), "proven")
    split = proven.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")

    single = known.select("digest", "keep_id", F.col("copies").alias("group_size"), "locator")
    if split.isEmpty():
        out = salted_join(landed.select("digest", "doc_id"), single, "digest", hot, "inner", "doc_id")
    else:
        whole = single.join(split, "digest", "left_anti")
        parted = _hits(texts, shared).join(split, "digest", "left_semi").select("digest", text_key, "doc_id")
        again = parted.join(proven, ["digest", "text_key"]).select("digest", "doc_id", "keep_id", "group_size", F.lit(None).cast("string").alias("locator"))
        out = salted_join(landed.select("digest", "doc_id"), whole, "digest", hot, "inner", "doc_id").unionByName(again)
    result = scratch.finish(out.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), F.col("digest").alias("text_sha256"), "locator"))
    shared.destroy()
    return result
