"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from starloom.plans.queries import ORACLES, QUERIES
from tools.check_queries import rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    cur = con.execute(ORACLES[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in cur.description], cur.fetchall())


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns == ["year", "month_name", "segment", "orders"]
    assert out.count() > 0
