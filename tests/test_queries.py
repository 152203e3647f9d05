"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"
NAMES = list(entry_points.QUERIES)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in ("lineitem", "orders", "supplier"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(name, spark, database):
    df = entry_points.QUERIES[name](spark, SF_DIR)
    sql = database.execute(entry_points.ORACLES[name])
    columns = [c[0] for c in sql.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted(repr([plain(row[c]) for c in columns]) for row in df.collect())
    expected = sorted(repr([plain(v) for v in row]) for row in sql.fetchall())
    assert got == expected


def test_every_query_has_a_twin():
    assert set(entry_points.ORACLES) == set(entry_points.QUERIES)
    assert set(entry_points.QUERIES) <= set(entry_points.queries())
