"""The suffix tree against a brute-force version, and counts that don't rise with the corpus."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cadenza.llm import suffixtree

from .fixtures import docs, pairs
from .test_models import LOW, held


def brute(table):
    found = [(d, [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)), None]) for d, t in pairs(table)]
    training = [w for d, w in found if not held(d, 10, 0)]
    words = Counter(x for w in training for x in w)
    bottom = sum(words.values()) + 0.1 * (len(words) + 1)
    totals = {1: Counter(), 2: Counter()}
    nexts = {1: defaultdict(Counter), 2: defaultdict(Counter)}
    for w in training:
        w = ["<s>", *w]
        for i in range(1, len(w)):
            for k in (1, 2):
                if i >= k:
                    nexts[k][tuple(w[i - k : i])][w[i]] += 1
                    totals[k][tuple(w[i - k : i])] += 1
    back, share = {}, {}

    def p(context, x):
        if not context:
            return (words[x] + 0.1) / bottom
        if context not in back:
            return p(context[1:], x)
        return share[context].get(x) or back[context] * p(context[1:], x)

    for k in (1, 2):
        for c, ns in nexts[k].items():
            ns = {x: n for x, n in ns.items() if n >= 4}
            if not ns:
                continue
            own = {x: (n - 0.5) / totals[k][c] for x, n in ns.items()}
            rest = max(1 - sum(own.values()), 1e-12) / max(1 - sum(p(c[1:], x) for x in ns), 1e-12)
            gain = sum(n * math.log(own[x] / p(c[1:], x)) for x, n in ns.items()) + (totals[k][c] - sum(ns.values())) * math.log(rest)
            if gain >= 0.01 * totals[k][c]:
                share[c], back[c] = own, rest
    score = lambda w: sum(math.log10(p(tuple(w[max(0, i - 2) : i]), w[i])) for i in range(1, len(w)))
    return sorted((str(d), len(w), score(["<s>", *w])) for d, w in found), len(back)


@pytest.mark.parametrize("heavy_pairs", [0, 20, 1 << 20])
def test_scores(spark, monkeypatch, heavy_pairs):
    monkeypatch.setattr(suffixtree, "HEAVY_PAIRS", heavy_pairs)
    if heavy_pairs < 1 << 20:
        monkeypatch.setattr(suffixtree, "HEAVY", 0.02)
    table = docs(spark, n=200)
    want, n = brute(table)
    assert n > 20
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in suffixtree.score(table).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-9)


def test_rare_pairs_are_learned_in_a_large_corpus(spark):
    filler = spark.range(1000, 1700).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(9000)), lambda x: F.concat(F.lit("f"), F.pmod(F.xxhash64("id", x), F.lit(5000))))).alias("text"))
    ids = [i for i in range(40) if not held(i, 10, 0)][:5]
    lot = spark.createDataFrame([(i, "alpha beta gamma") for i in ids], "doc_id long, text string")
    got = suffixtree.score(filler.unionByName(lot)).filter("doc_id < 1000").collect()
    assert len(got) == 5 and got[0]["train_tokens"] > 5 * 2**20
    assert all(r["score"] - r["base_score"] > 10 for r in got)
