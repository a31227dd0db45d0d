"""The whole classifier at production limits against the definition."""

import re
from collections import Counter

import duckdb

from cadenza.plans import catalogue

DATA = "/root/testdata/sf0.001"


def repeat_count(t):
    for size in range(2, min(200, len(t) // 2) + 1):
        for i in range(len(t) - 2 * size + 1):
            n = 1
            while t[i : i + size] == t[i + n * size : i + (n + 1) * size]:
                n += 1
            if n > 1:
                return n
    return 0


def reasons(text, duration):
    t = (text or "").strip()
    if len(t) < 1000:
        return ""
    if re.search(r"([^\n])\1{80}", t):
        return "hard_same_char_run"
    counts = Counter(t)
    found = {"speed": len(t) / duration > 12, "low_unique": len(counts) / len(t) < 0.1, "max_char_ratio": max(counts.values()) / len(t) > 0.55, "repeated_chunk": repeat_count(t) >= 6}
    return ",".join(k for k, v in found.items() if v)


def test_all_rules(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall()
    want = {d: reasons(t, d % 300 + 1) for d, t in docs}
    got = {r["doc_id"]: r["reasons"] for r in catalogue.queries()["fn07_all_rules"](spark, DATA).collect()}
    assert got == want
    assert sum("repeated_chunk" in r for r in want.values()) == 4
