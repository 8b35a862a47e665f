"""Each query of the core against its SQL in DuckDB, on whole tables."""

import glob
import math
import os

import duckdb
import pytest

from docaudit.plans import catalog


def value(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or hasattr(v, "as_integer_ratio"):
        return round(float(v), 9)
    return str(v)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_agrees_with_sql(spark, data, duck, name):
    df = catalog.queries()[name](spark, data)
    got = sorted((tuple(map(value, r)) for r in df.collect()), key=repr)
    answer = duck.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in df.columns]
    assert got == sorted((tuple(value(r[i]) for i in order) for r in answer.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_runs(spark, data, name):
    df = catalog.queries()[name](spark, data)
    rows = df.collect()
    assert rows and len(set(df.columns)) == len(df.columns) and all(any(r[c] is not None for r in rows) for c in df.columns)


def test_entry(spark, data):
    rows = catalog.flagship(spark, data).collect()
    assert {r.field for r in rows} == {"lang", "subtype", "source"} and not any(math.isnan(r.avg_score) for r in rows)
