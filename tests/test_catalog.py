"""Every catalogue query against its DuckDB formulation at sf0.001."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from pitpanel.plans.catalog import QUERIES
from pitpanel.plans.oracle import SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "EvalPython" not in plan
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    want = rows([d[0] for d in res.description], res.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    assert got == want


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "fye_bin"


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
