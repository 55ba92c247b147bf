"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, queries
from check import TABLES, compare
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, SF)
    rows = frame.collect()
    result = db.execute(ORACLES[name])
    assert compare(frame.columns, rows, [c[0] for c in result.description], result.fetchall()) == "ok"


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
