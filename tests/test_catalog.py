"""Every registered query against its SQL twin on DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from helpers import SF_DIR
from tocsin.plans import catalog


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def _shown(rows, order):
    return sorted(tuple(repr(row[i] + 0.0 if isinstance(row[i], float) else row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    answer = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(df.columns)
    expected = answer.fetchall()
    order = [columns.index(c) for c in sorted(columns)]
    mine = [df.columns.index(c) for c in sorted(columns)]
    assert _shown(df.collect(), mine) == _shown(expected, order)


def test_entry_gives_rows(spark):
    assert driver.entry(spark).count() == 5
