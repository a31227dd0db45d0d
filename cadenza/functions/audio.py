"""Sample arrays: mono mix, resampling, padding; and the losses of frame scores."""

from __future__ import annotations

from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType

from cadenza.functions.arrays import softmax


def mono(channels: Column) -> Column:
    """The mean of an array of channels of equal length."""
    n = F.size(channels)
    return F.transform(F.element_at(channels, 1), lambda _, i: F.aggregate(channels, F.lit(0.0), lambda s, c: s + F.get(c, i).cast("double")) / n)


def resampled(x: np.ndarray, rate: int, to: int, width: int = 6, rolloff: float = 0.99) -> np.ndarray:
    """Samples at another rate by a sinc kernel under a squared cosine window, one phase an output sample."""
    if rate == to or not len(x):
        return np.asarray(x, dtype=np.float64)
    step = gcd(rate, to)
    old, new = rate // step, to // step
    edge = min(old, new) * rolloff
    reach = int(np.ceil(width * old / edge))
    t = np.clip((np.arange(-reach, reach + old)[None, :] / old - np.arange(new)[:, None] / new) * edge, -width, width)
    kernel = np.sinc(t) * np.cos(t * np.pi / width / 2) ** 2 * edge / old
    n = -(-len(x) * new // old)
    room = np.concatenate([np.zeros(reach), x, np.zeros(reach + 2 * old)])
    frames = np.lib.stride_tricks.sliding_window_view(room, kernel.shape[1])[::old][: -(-n // new)]
    return (frames @ kernel.T).ravel()[:n]


def resample(samples: Column, rate: int, to: int) -> Column:
    @pandas_udf(ArrayType(DoubleType()))
    def run(lists: pd.Series) -> pd.Series:
        return lists.map(lambda x: None if x is None else resampled(np.asarray(x, dtype=np.float64), rate, to))

    return run(samples)


def padded(samples: Column, length: Column) -> Column:
    """struct<values, is_padding>: the samples with zeros up to ``length``, and which places are filled up."""
    missing = F.greatest(length - F.size(samples), F.lit(0))
    values = F.concat(samples, F.array_repeat(F.lit(0.0), missing))
    return F.struct(values.alias("values"), F.transform(values, lambda _, i: i >= F.size(samples)).alias("is_padding"))


def padded_batches(df: DataFrame, batch: list[str], samples: str) -> DataFrame:
    """``df`` with ``padded``: samples filled up to the longest of their batch."""
    return df.withColumn("padded", padded(F.col(samples), F.max(F.size(samples)).over(W.partitionBy(*batch))))


def variation_loss(scores: Column, target: Column | None = None, power: float = 1.0, weight: float = 0.4, edge: float = 0.01, near: float = 0.1) -> Column:
    """Weighted mean of the differences between neighbouring scores; those beside a boundary of the target count ``near``."""
    left, right = F.slice(scores, F.lit(1), F.size(scores) - 1), F.slice(scores, F.lit(2), F.size(scores) - 1)
    steps = F.zip_with(left, right, lambda a, b: F.pow(F.abs(b - a) + 1e-8, F.lit(power)))
    if target is not None:
        steps = F.transform(steps, lambda d, i: d * F.when((F.get(target, i) > edge) | (F.get(target, i + 1) > edge), near).otherwise(1.0))
    return F.when(F.size(scores) > 1, weight * F.aggregate(steps, F.lit(0.0), lambda s, d: s + d) / F.size(steps))


def focal_loss(logits: Column, label: Column, alpha: float = 0.25, gamma: float = 2.0) -> Column:
    """Softmax focal loss of one frame's logits and its label (from 0)."""
    p = F.least(F.greatest(F.get(softmax(logits), label), F.lit(1e-8)), F.lit(1 - 1e-8))
    return (alpha if alpha > 0 else 1.0) * F.pow(1 - p, F.lit(gamma)) * -F.log(p)


def combined_loss(parts: dict[str, Column], weights: dict[str, float]) -> Column:
    """The weighted sum of losses; one without a weight counts once."""
    out = F.lit(0.0)
    for name, part in parts.items():
        out = out + weights.get(name, 1.0) * part
    return out
