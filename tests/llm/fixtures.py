"""Small documents with all that operators must bear, and the rows of a query for brute-force versions."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rep string, key string, node long, component long, name string"
WORDS = "ab ba cab dab the The THE ndon ertion élan mañana x1 42 naïve ŝi 日本 loser, end. stop! a|b".split()


def docs(spark, extra=(), n=60, seed=1):
    """Random texts, near and exact copies, null and empty texts, a null id, a repeated row, a very long text and clashing column names."""
    rng = random.Random(seed)
    text = lambda k: " ".join(rng.choice(WORDS) + (str(rng.randrange(60)) if rng.random() < 0.7 else "") for _ in range(k))
    rows = [(i, text(rng.choice([1, 3, 5, 12, 40, 90]))) for i in range(n)]
    base = text(70)
    passage = text(45)
    rows += [(100 + i, " ".join(w if j % 35 != i else "new" + str(i) for j, w in enumerate(base.split()))) for i in range(4)]
    rows += [(110 + i, base) for i in range(3)]
    rows += [(120 + i, text(5) + " " + passage + "\n" + text(6)) for i in range(4)]
    rows += [(130, None), (131, ""), (132, " \t\n"), (133, None), (134, "Word"), (135, "word"), (136, "a b c d e"), (137, "e d c b a " * 300), (None, "no id here at all"), (None, base)]
    rows += [(138, rows[0][1]), (139, "x" * 3000), (140, "x" * 3000 + "y"), (141, "one two three four five six"), (141, "one two three four five six")]
    rows += list(extra)
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "r", "k", 1, 2, "n") for i, t in rows], SCHEMA)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def key(x):
    return (x is None, x if x is not None else 0)


def rows(df, *columns):
    """The rows as sorted tuples."""
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda t: [(v is None, str(type(v)), v if v is not None else 0) for v in t])


def same(got, want):
    order = lambda t: [(v is None, str(type(v)), v if v is not None else 0) for v in t]
    assert sorted(got, key=order) == sorted(want, key=order)
