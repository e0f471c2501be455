"""Every query with a SQL twin, side by side on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, TWINS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def shown(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [sorted(columns)] + sorted([shown(r[i]) for i in order] for r in rows)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_matches_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    twin = duck.sql(TWINS[name])
    assert table([tuple(r) for r in df.collect()], df.columns) == table(
        twin.fetchall(), twin.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(TWINS)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
