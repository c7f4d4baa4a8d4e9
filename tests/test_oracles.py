"""Each registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from tallystone.plans.oracles import ORACLES
from tallystone.plans.queries import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("customer", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 6)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((repr(tuple(plain(r[i]) for i in order)) for r in rows))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    want = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    expected = bag(columns, want.fetchall())
    actual = bag(got.columns, [tuple(r) for r in got.collect()])
    assert len(actual) == len(expected)
    assert actual == expected


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
