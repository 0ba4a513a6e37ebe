"""Every catalogue query against its DuckDB oracle on the smallest test tables."""

import datetime as dt
import decimal
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_mod
from conftest import SF

from nestlift.plans.catalog import QUERIES
from nestlift.plans.oracle import ORACLE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        v = v.replace(tzinfo=None)
        return v.date().isoformat() if v.time() == dt.time() else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(r):
    return tuple((x is None, str(type(x)), str(x)) for x in r)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["c_custkey", "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                          "step", "flag", "price"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(_norm(x) for x in r) for r in df.collect()]
    odf = duck.execute(ORACLE[name]).fetchdf()
    assert sorted(df.columns) == sorted(odf.columns)
    idx = [list(odf.columns).index(c) for c in df.columns]
    want = [tuple(_norm(r[i]) for i in idx) for r in odf.itertuples(index=False, name=None)]
    assert sorted(got, key=_key) == sorted(want, key=_key)
