"""Every registered query equals its SQL, value by value and type by type, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from lakeward.workload import oracle, registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}

QUERIES, SQL = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == columns
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[t] for c, t in result.dtypes} == expected_types
    places = [relation.columns.index(c) for c in columns]
    expected = [tuple(row[i] for i in places) for row in relation.fetchall()]
    actual = [tuple(row[c] for c in columns) for row in result.collect()]
    assert _ordered(actual) == _ordered(expected)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
