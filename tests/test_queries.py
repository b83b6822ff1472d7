"""Every registered schedule query against its SQL on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from feedloom.plans import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        path = f"{DATA}/{f}"
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{path}/*.parquet')" if os.path.isdir(path) else f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{path}')")
    return c


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        return f"{value:.6g}"
    return str(value)[:10] if hasattr(value, "year") else f"{float(value):.6g}" if type(value).__name__ == "Decimal" else str(value)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, duck, name):
    df = queries.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    sql = duck.sql(queries.oracle_sql()[name])
    assert sorted(sql.columns) == columns
    at = [sql.columns.index(c) for c in columns]
    want = sorted(tuple(plain(r[i]) for i in at) for r in sql.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
