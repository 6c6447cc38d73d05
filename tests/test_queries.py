"""Every registered query against its SQL, run by DuckDB on the same files."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        connection.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return connection


def by_name(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, sql, name):
    df = driver.queries()[name](spark, SF)
    found = [tuple(r) for r in df.collect()]
    text = driver.oracle_sql().get(name)
    if text is None:
        assert found
        return
    expected = sql.sql(text)
    assert sorted(df.columns) == sorted(expected.columns)
    assert by_name(found, df.columns) == by_name(expected.fetchall(), expected.columns)


def test_flagship(spark):
    assert driver.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
