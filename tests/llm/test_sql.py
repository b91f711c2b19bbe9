"""The operators' queries against their SQL."""

import duckdb
import pytest

from catchlake.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    cursor = connection.execute(queries.SQL[name])
    names, rows = [d[0] for d in cursor.description], cursor.fetchall()
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    assert columns == sorted(names)
    theirs = sorted((repr(tuple(r[names.index(c)] for c in columns)) for r in rows))
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == theirs
