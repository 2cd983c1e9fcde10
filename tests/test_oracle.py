"""Every core query with SQL against DuckDB on whole tables; every other core query runs."""

from __future__ import annotations

import importlib
import math
import os

import duckdb
import pytest

from scriptorium.plans import alignments, data_problems, folding, relational, scalars

QUERIES = {**data_problems.QUERIES, **scalars.QUERIES, **relational.QUERIES, **alignments.QUERIES, **folding.QUERIES}
SQL = {**data_problems.SQL, **scalars.SQL, **relational.SQL, **alignments.SQL}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v.isoformat().replace("+00:00", "") if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(sf):
        con.execute(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(map(norm, r)) for r in df.select(*columns).collect()), key=repr)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    assert got == sorted((tuple(norm(r[i]) for i in place) for r in result.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() >= 0


def test_entry_module():
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
