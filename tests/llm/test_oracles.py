"""The registered queries of this subpackage give the rows of their SQL."""

import os

import duckdb
import pytest

from sondeframe.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for name in "documents embeddings pages".split():
        path = f"{sf}/{name}.parquet"
        c.execute(f"create view {name} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    want = duck.sql(ORACLE[name])
    assert sorted(want.columns) == columns
    order = lambda rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    assert order(map(tuple, got.select(*columns).collect())) == order(want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
