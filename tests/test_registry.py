"""Every registered query against its SQL on the smallest benchmark folder."""

from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as registered
from tests.conftest import TESTDATA

QUERIES, CHECKS = registered.queries(), registered.oracle_sql()
OWN = sorted(set(QUERIES) - set(registered.LLM_QUERIES) - set(registered.PIPELINE))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("nation", "customer", "supplier", "part", "orders", "lineitem"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    return connection


def _comparable(value):
    return value.normalize() if isinstance(value, Decimal) else value


def _multiset(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return Counter(tuple(_comparable(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_its_check(spark, duck, name):
    result = QUERIES[name](spark, TESTDATA)
    cursor = duck.execute(CHECKS[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert _multiset(result.columns, [tuple(r) for r in result.collect()]) == _multiset(columns, cursor.fetchall())


def test_flagship_entry(spark):
    assert registered.entry(spark).columns == ["Periode", "Magasin", "CA_EUR", "Nb_Ventes", "Nb_Clients"]
