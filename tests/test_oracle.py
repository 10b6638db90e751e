"""Every registered query with an oracle gives the same rows as DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

from sondeframe.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(df):
    def plain(v):
        if v is None or v is pd.NA or v != v:
            return None
        if hasattr(v, "year"):
            return str(v)[:10]
        return round(float(v), 3) + 0.0 if isinstance(v, float) else v

    df = df[sorted(df.columns)]
    return list(df.columns), sorted((tuple(map(plain, r)) for r in df.astype(object).itertuples(index=False)), key=repr)


def close(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 2e-3)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_as_duckdb(spark, duck, name):
    got, want = rows(registry.QUERIES[name](spark, SF).toPandas()), rows(duck.sql(registry.ORACLE[name]).df())
    assert got[0] == want[0] and len(got[1]) == len(want[1])
    for a, b in zip(got[1], want[1], strict=True):
        assert all(map(close, a, b)), (a, b)
