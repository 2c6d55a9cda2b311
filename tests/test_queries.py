"""Every core query against its SQL on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from dossier.plans import catalogue

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    order = [d[0] for d in result.description]
    assert sorted(order) == columns
    assert got == sorted(repr(tuple(plain(r[order.index(c)]) for c in columns)) for r in result.fetchall())
