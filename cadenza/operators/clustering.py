"""k-means over vectors, as one aggregate per round; only the k centres are on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.arrays import l2_normalize, nearest_of


def kmeans(df: DataFrame, key: str, vector: str, k: int, rounds: int = 10, metric: str = "cosine") -> DataFrame:
    """(key, cluster): the first k by key are the first centres; a cluster without members keeps its centre.

    ``cosine`` works on normalised vectors and normalises the means; ``l2`` works on the vectors as they are.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"no such metric: {metric}")
    own = l2_normalize(F.col(vector)) if metric == "cosine" else F.transform(vector, lambda x: x.cast("double"))
    rows = df.select(key, own.alias("v"))
    centres = [list(r["v"]) for r in rows.orderBy(key).limit(k).collect()]
    for _ in range(rounds if centres else 0):
        means = rows.select(nearest_of(F.col("v"), centres).alias("c"), F.posexplode("v").alias("i", "x")).groupBy("c", "i").agg(F.avg("x").alias("m"))
        listed = means.groupBy("c").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda p: p["m"]).alias("v"))
        new = {r["c"]: r["v"] for r in listed.select("c", (l2_normalize(F.col("v")) if metric == "cosine" else F.col("v")).alias("v")).collect()}  # k rows
        moved = [list(new.get(i, c)) for i, c in enumerate(centres)]
        if moved == centres:
            break
        centres = moved
    return rows.select(key, (nearest_of(F.col("v"), centres) if centres else F.lit(None).cast("long")).alias("cluster"))
