"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as contract
from catchlake.checks import CHECKS
from catchlake.fixtures import BASE_TABLES, VIEWS, Tables, with_views

FOLDER = "/root/testdata/sf0.001"

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in BASE_TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def answer(duck, sql):
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


def same(df, names, rows):
    columns = sorted(df.columns)
    assert columns == sorted(names)
    mine = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    theirs = sorted((tuple(r[names.index(c)] for c in columns) for r in rows), key=repr)
    assert list(map(repr, mine)) == list(map(repr, theirs))


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_view(spark, duck, name):
    same(getattr(Tables(spark, FOLDER), name), *answer(duck, with_views(f"select * from {{{name}}}")))


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, duck, name):
    same(QUERIES[name](spark, FOLDER), *answer(duck, ORACLES[name]))


def test_flagship(spark):
    assert contract.entry(spark).columns == contract.queries()[contract.FLAGSHIP](spark, FOLDER).columns
