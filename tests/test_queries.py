"""Every registered query against its SQL twin on the smallest tables."""

import math
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def cell(v):
    if isinstance(v, (bool, np.bool_, str)):
        return str(v)
    if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>"):
        return "~"
    return f"{v + 0.0:.9g}" if isinstance(v, (int, float, np.number)) else str(v)


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(cell(v) for v in r) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = rows(QUERIES[name](spark, SF).toPandas())
    assert got[1]
    if name in ORACLES:
        assert got == rows(duck.execute(ORACLES[name]).df())


def test_entry(spark):
    assert contract.entry(spark).count() == 5507


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
