"""The operators' registered SQL against their queries on whole small tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from clickstrata.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "embeddings", "benchmark")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    found = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    expected = Counter(cursor.fetchall())
    assert Counter(map(tuple, found.select(*columns).collect())) == expected
