"""Deterministic choices from hashes: the same row gets the same choice in every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (of 100) of SHORT and MEDIUM per style; the rest is LONG.
LENGTH_BOUNDS = {"sections": (15, 70), "paragraph": (60, 90)}
#: Parts that the unit interval is cut into for a choice.
STEPS = 1 << 20


def hash32(c: Column) -> Column:
    """The first 32 bits of md5 as a number."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long")


def length_class(key: Column, style: Column) -> Column:
    """SHORT, MEDIUM or LONG for a key and a normalised style."""
    x = hash32(F.concat_ws(":", key, style)) % 100
    out = F.lit(None).cast("string")
    for name, (short, medium) in LENGTH_BOUNDS.items():
        out = F.when(style == name, F.when(x < short, "SHORT").when(x < medium, "MEDIUM").otherwise("LONG")).otherwise(out)
    return out


def seed(key: Column) -> Column:
    return F.substring(F.sha1(key), 1, 8)


def uniform(key: Column, salt: str) -> Column:
    """A number in [0, 1) from a key."""
    return (hash32(F.concat(key, F.lit(salt))) % STEPS) / F.lit(float(STEPS))


def weighted_choice(key: Column, weights: dict[str, float], default: str, salt: str = "") -> Column:
    """A name by its weight: the first whose running weight reaches the draw. Negative weights don't count."""
    items = [(k, float(w)) for k, w in weights.items() if w is not None and float(w) >= 0]
    total = sum(w for _, w in items)
    if total <= 0:
        return F.lit(default)
    draw, run, out = uniform(key, salt) * total, 0.0, None
    for name, w in items[:-1]:
        run += w
        out = F.when(draw <= run, name) if out is None else out.when(draw <= run, name)
    return F.lit(items[-1][0]) if out is None else out.otherwise(items[-1][0])


def pool_choice(key: Column, pool: list[str], salt: str = "") -> Column:
    """One of the pool, each alike."""
    return F.element_at(F.array(*[F.lit(x) for x in pool]), (hash32(F.concat(key, F.lit(salt))) % len(pool) + 1).cast("int"))


def parse_weights(json: Column, allowed: list[str]) -> Column:
    """A JSON object of weights, restricted to ``allowed`` names and weights that aren't negative; null if none is left."""
    found = F.map_filter(F.from_json(json, "map<string,double>"), lambda k, v: k.isin(allowed) & (v >= 0))
    return F.when(F.size(found) > 0, found)
