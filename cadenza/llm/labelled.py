"""Bounded samples of labelled rows, for the two classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import id_and_text, small_batches


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most ``max_rows`` labelled documents outside the held-out remainder: doc_id, text, label.

    The rows with the smallest hash of their id are taken, whatever the partitioning. Null labels don't count; of
    several labels of one id the largest holds, of several texts the least in byte order. The ids are bounded by ``max_rows``, so they are broadcast
    and only their texts are shuffled.
    """
    wanted = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label")).dropna().filter(remainder("doc_id", modulus) != held)
    wanted = wanted.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return id_and_text(docs, id_col, text_col).join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def fit_in_one_task(rows: DataFrame, fit: Callable[[pd.DataFrame], bytes]) -> bytes:
    """The model that ``fit`` makes of all (bounded) ``rows`` in one executor task; of no rows too."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.to_pandas() for b in batches]
        frame = pd.concat(parts) if parts else pd.DataFrame({n: [] for n in names})
        yield pa.RecordBatch.from_pydict({"model": [fit(frame.sort_values("doc_id", kind="stable"))]}, schema=pa.schema([("model", pa.binary())]))

    with small_batches(rows.sparkSession):
        found = rows.repartition(1).mapInArrow(run, "model binary").first()
    return bytes(found["model"]) if found else fit(pd.DataFrame({n: [] for n in names}))  # no rows may mean no task
