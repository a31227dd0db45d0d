"""Every query of the engine by name, with its DuckDB counterpart, and the flagship query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators import aggregates as G
from cadenza.operators import sequences as S
from cadenza.plans import join_queries, sequence_queries, source_queries, text_queries  # noqa: F401  they register their queries
from cadenza.plans.registry import QUERIES, SQL, Query, events


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered segments merged to islands, one array per song."""
    numbered = S.number_occurrences(events(spark, sf_dir), ["song"], "label", ["us", "event_id"])
    spans = S.islands(numbered.withColumns({"start": F.col("us"), "end": F.col("us")}), ["song"], "label", ["us", "event_id"], "start", "end")
    return G.segments_per_song(spans, "song", "start", ["end", "label"], ["label", "start", "end", "n"])


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
