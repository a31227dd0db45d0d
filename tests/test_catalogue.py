"""Every query of the engine against DuckDB, over the smallest tables."""

import duckdb
import pandas as pd
import pytest

from cadenza.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if frame[c].dtype == object:
            frame[c] = frame[c].map(lambda v: None if v is None else str(v))
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    out = catalogue.queries()[name](spark, DATA)
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert out.count() > 0
    else:
        pd.testing.assert_frame_equal(plain(out.toPandas()), plain(duck.execute(sql).df()), check_dtype=False, rtol=1e-9)


def test_flagship(spark):
    assert catalogue.flagship(spark, DATA).count() > 0
