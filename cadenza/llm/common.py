"""What the operators of this subpackage share: scratch tables, skew-safe joins, text columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.storage import BATCH_CONF, BATCH_ROWS, Scratch, shared_dir, small_batches  # noqa: F401  the operators' tables

#: A key is hot when it holds at least 1/HOT_SHARE of all rows, so at most HOT_SHARE keys are hot:
#: that is the proven bound of every broadcast list of hot keys.
HOT_SHARE = 1000
#: Rows of a hot key are dealt over so many salts.
SALTS = 64


def text_of(column: str = "text") -> Column:
    """The text with null as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the two columns every operator reads, named ``doc_id`` and ``text``; null text is empty."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def hashes_of(hot: DataFrame, key: str) -> list[int]:
    """The hashes of the hot keys, for ``salted_join``: at most HOT_SHARE, so they fit in the plan."""
    return [r[0] for r in hot.select(F.xxhash64(key)).distinct().collect()]


def salted_join(big: DataFrame, small: DataFrame, key: str, hot: DataFrame | list[int], how: str, spread: str) -> DataFrame:
    """``big`` joined with ``small`` (one row per key) on ``key``, with the hot keys dealt over salts.

    ``hot`` has the hot keys and must be bounded (see HOT_SHARE), as it is broadcast. ``spread`` is an SQL
    expression over ``big`` that differs between the rows of a key. Rows of ``small`` are repeated
    once per salt for hot keys alone. Given as hashes (``hashes_of``), hot keys are marked by a set within the plan, and no row goes through a
    join for it; a key of the same hash is dealt, too, on both sides.
    """
    if isinstance(hot, list):
        is_hot = F.xxhash64(key).isin(hot)
        dealt = big.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(F.expr(spread)), F.lit(SALTS))).otherwise(F.lit(0)).cast("int"))
        copies = small.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
        return dealt.join(copies, [key, "_salt"], how).drop("_salt")
    marks = F.broadcast(hot.select(F.col(key).alias("_hot_key")).distinct())
    dealt = big.join(marks, big[key] == marks["_hot_key"], "left").withColumn(
        "_salt", F.when(F.col("_hot_key").isNotNull(), F.pmod(F.xxhash64(F.expr(spread)), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    )
    copies = small.join(marks, small[key] == marks["_hot_key"], "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot_key").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    )
    return dealt.drop("_hot_key").join(copies.drop("_hot_key"), [key, "_salt"], how).drop("_salt")


def with_rows(texts: DataFrame) -> tuple[DataFrame, bool]:
    """``texts`` (doc_id, text) with a column ``row`` that names its row, and whether no two rows have the same one.

    Where ids are unique the id itself is the name. Otherwise it is a hash of id and text, so repeated rows share one; that no other rows do
    is proven by a second hash, and another seed is taken if they do.
    """
    if texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL").isEmpty():
        return texts.withColumn("row", F.col("doc_id")), True
    for seed in range(8):
        named = texts.withColumn("row", F.xxhash64(F.lit(seed), "doc_id", "text"))
        other = F.xxhash64("text", "doc_id", F.lit(~seed))
        if named.groupBy("row").agg(F.min(other).alias("least"), F.max(other).alias("most")).filter("least <> most").isEmpty():
            return named, False
    raise ValueError("rows without unique ids are too many to be named by 64 bits")


@contextmanager
def measured_joins(spark: SparkSession) -> Iterator[None]:
    """No side of a join is broadcast by its estimated size within; only what is marked, which has a bound of its own."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
