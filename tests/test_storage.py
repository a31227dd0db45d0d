"""The scratch tables' care for the driver's memory."""

from cadenza import storage
from cadenza.llm.common import hashes_of, salted_join


def test_every_table_gives_native_memory_back(spark, monkeypatch):
    seen, trim = [], storage.trim_native_heap
    monkeypatch.setattr(storage, "trim_native_heap", lambda s: seen.append(trim(s)))
    scratch = storage.Scratch(spark, "storage-test")
    for i in range(3):
        scratch.table(spark.range(10), f"some-{i}")
        assert seen == [True] * (i + 1)
    scratch.release()
    assert seen == [True] * 4


def test_trimming_is_left_out_where_there_is_no_such_command(spark, monkeypatch):
    monkeypatch.setattr(storage, "TRIM", "noSuchCommand")
    assert not storage.trim_native_heap(spark)
    assert storage.Scratch(spark, "storage-test").table(spark.range(10), "some").count() == 10


def test_hot_keys_given_as_hashes_need_no_join(spark):
    """Same rows as with hot keys as a table; the only join is the one with the other side."""
    big = spark.range(400).selectExpr("id % 7 AS k", "id").selectExpr("named_struct('a', k) AS key", "id")
    small = spark.range(6).selectExpr("named_struct('a', id) AS key", "id * 10 AS x")
    hot = big.limit(1).select("key")
    got = salted_join(big, small, "key", hashes_of(hot, "key"), "inner", "id")
    assert sorted(got.collect()) == sorted(salted_join(big, small, "key", hot, "inner", "id").collect())
    assert got.count() == got.select("id").distinct().count() == 343
    assert "LeftOuter" not in got._jdf.queryExecution().toString()
