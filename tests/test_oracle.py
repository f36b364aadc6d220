"""Every registered query against its independent SQL, value by value."""

from __future__ import annotations

import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from hand_rows import plan_of

from __spark_entry__ import entry
from clickstrata.plans.catalog import registered
from clickstrata.plans.oracle import oracle_queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# No query pairs rows without a key, leaves the JVM, limits its rows or needs a
# whole table in every task.
UNWANTED = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "PythonUDF",
    "EvalPython",
    "isNullAwareAntiJoin=true",
    "CollectLimit",
    "GlobalLimit",
)
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'"
        )
    yield connection
    connection.close()


def _plain(value):
    assert not isinstance(value, (Decimal, date, datetime)), "not a portable type"
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(registered()) == set(oracle_queries())


@pytest.mark.parametrize("name", sorted(registered()))
def test_matches_oracle(spark, duck, name):
    actual = registered()[name](spark, FOLDER)
    cursor = duck.execute(oracle_queries()[name])
    expected_columns = [d[0] for d in cursor.description]
    assert sorted(actual.columns) == sorted(expected_columns)
    expected = _bag(expected_columns, cursor.fetchall())
    found = _bag(actual.columns, actual.collect())
    assert found == expected
    plan = plan_of(actual)
    assert not [unwanted for unwanted in UNWANTED if unwanted in plan]


def test_entry_runs(spark):
    assert entry(spark).count() == 25
