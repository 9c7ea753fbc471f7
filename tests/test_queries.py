"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from rivermart.plans import oracles, queries

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
QUERIES, ORACLE = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def comparable(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(None if row[i] is None else str(row[i]) for i in order) for row in data]
    return sorted(columns), sorted(picked, key=lambda row: tuple((v is None, v or "") for v in row))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, database, name):
    frame = QUERIES[name](spark, sf_dir)
    got = comparable(frame.columns, frame.collect())
    result = database.execute(ORACLE[name])
    expected = comparable([column[0] for column in result.description], result.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1]) > 0
    assert got[1] == expected[1]


def test_entry(spark, sf_dir):
    assert entry.entry(spark).columns[-1] == "category3_name"
