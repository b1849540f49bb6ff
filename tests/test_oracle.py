"""Every registered query against its SQL: columns, types, rows and values."""

from __future__ import annotations

import os

import compare
import pytest

import __spark_entry__ as entry_points
from ledgerspark.checks.oracle import ORACLE_SQL
from ledgerspark.checks.registry import QUERIES as LIBRARY_QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = {k: v for k, v in entry_points.oracle_sql().items() if k in ORACLE_SQL}
QUERIES = {k: v for k, v in entry_points.queries().items() if k in LIBRARY_QUERIES}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR).toArrow()
    assert compare.multiset_diff(duck, result, SQL[name]) == []


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:3] == ["fiscal_year", "month", "department_name"]
    assert df.count() > 0
