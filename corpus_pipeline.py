"""The corpus pipeline: five stages over ``documents``, each a function (spark, docs, sf_dir) -> DataFrame.

Each stage works on all rows its predecessor kept; all but the last return the columns of ``documents``. ``run``
writes each stage's rows as Parquet in the shared folder and reads them again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import decontaminate, exact_dedup, minhash, packing, quality
from cadenza.llm.common import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The first stage's scores come from a trained model, which SQL can't express.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _written(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """``rows`` as a table: whole texts go through Python workers in small batches whoever reads the stage."""
    return Scratch(spark, name).finish(rows)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score under 0.7; the labels are of the documents of ``sf_dir``."""
    model = quality.train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return _written(spark, "quality", quality.score(docs.select(*COLUMNS), model).filter("predicted = 1").select(*COLUMNS))


def _rows_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``kept`` has by id and text (text_sha256): another text under the same id is another document."""
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    same = docs["doc_id"].eqNullSafe(kept["_id"]) & (F.sha2(F.coalesce(docs["text"], F.lit("")), 256) == kept["_sha"])
    return docs.join(kept, same, "left_semi").select(*COLUMNS)


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays (repeated rows of it all do)."""
    return _rows_of(docs, exact_dedup.exact_dedup(docs).filter("kept"))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (components of links) the document with the smallest id stays."""
    return _rows_of(docs, minhash.near_duplicates(docs).filter("kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents at least a twentieth of whose words benchmark windows cover; the rest stays as it is, and nothing is shuffled."""
    found = decontaminate.contamination(docs.withColumn("no_text", F.col("text").isNull()), _table(spark, sf_dir, "benchmark"), carry=["lang", "source", "n_chars", "no_text"])
    clean = found.filter("NOT contaminated").withColumn("text", F.when(~F.col("carried.no_text"), F.col("text")))
    return _written(spark, "clean", clean.select("doc_id", "text", "carried.lang", "carried.source", "carried.n_chars").select(*COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, with their sequences and places."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_deduplication),
    ("MinHash near-dedup", near_deduplication),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    scratch = Scratch(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage-{i}")
        scratch.drop(f"stage-{i - 1}")
    return docs
