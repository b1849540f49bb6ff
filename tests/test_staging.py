"""Staging against its plain definition, on lines with every kind of untidiness."""

from __future__ import annotations

import compare
import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from ledgerspark.checks.oracle import TABLES
from ledgerspark.plans import RAW_COLUMNS, stage_ledger

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in [*RAW_COLUMNS, "source_path"]])

SPACES = st.sampled_from(["", "", "", " ", "  ", "\t", "\u00a0", " \u2003", "\u3000 "])
CODES = st.sampled_from(["", "090", "a b", "\u00e9", "x\u00a0y"])
NUMBERS = st.sampled_from(["2024", "2024.0", "1.5", "2.5", "1e3", "n/a", "5d", "0x1p3", "", "nan"])


def padded(values):
    return st.one_of(st.none(), st.builds(lambda a, v, b: a + v + b, SPACES, values, SPACES))


def mostly(values):
    """Present far more often than not, so that many lines are complete."""
    good = st.builds(lambda a, b: f"{a}090{b}", SPACES, SPACES)
    return st.one_of(good, good, good, good, good, padded(values))


columns = {c: padded(CODES) for c in RAW_COLUMNS}
columns |= {c: mostly(CODES) for c in ("AGENCYNBR", "LEDGER", "FUND_CODE", "DEPTID")}
columns |= {c: mostly(CODES) for c in ("ACCOUNT", "ROWID")}
columns |= {c: mostly(NUMBERS) for c in ("FISCAL_YEAR", "ACCOUNTING_PERIOD")}
columns["POSTED_TOTAL_AMT"] = st.sampled_from(["1.005", " -2.50", "0", "1e2", None])
columns["source_path"] = st.sampled_from(["ledger_fy24_qtr1.csv", "ledger_fy24_qtr2.csv"])
lines = st.lists(st.fixed_dictionaries(columns), min_size=5, max_size=60)


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(lines)
def test_staging_equals_its_definition(spark, data):
    raw = spark.createDataFrame([tuple(r[f.name] for f in SCHEMA) for r in data], SCHEMA)
    duck = duckdb.connect()
    duck.register("raw", raw.toArrow())
    assert compare.multiset_diff(duck, stage_ledger(raw).toArrow(), TABLES["silver"][1]) == []


LINE = {
    "AGENCYNBR": "090",
    "LEDGER": "ACTUALS",
    "FISCAL_YEAR": "2024",
    "ACCOUNTING_PERIOD": "1",
    "FUND_CODE": "100",
    "DEPTID": "D1",
    "ACCOUNT": "5",
    "POSTED_TOTAL_AMT": "10.00",
    "ROWID": "r1",
    "source_path": "ledger_fy24_qtr1.csv",
}


def stage_one(spark, line, **options):
    values = {**LINE, **line}
    raw = spark.createDataFrame([tuple(values.get(f.name) for f in SCHEMA)], SCHEMA)
    rows = stage_ledger(raw, **options).collect()
    return rows[0] if rows else None


@pytest.mark.parametrize("column", ["AGENCYNBR", "LEDGER", "FISCAL_YEAR", "DEPTID", "ROWID"])
@pytest.mark.parametrize("blank", [None, "", "  ", "\u00a0"])
def test_blank_codes_drop_the_line(spark, column, blank):
    assert stage_one(spark, {column: blank}) is None


def test_spaces_of_fund_and_account_stay(spark):
    row = stage_one(spark, {"FUND_CODE": " ", "ACCOUNT": " 5 "})
    assert (row.fund_code, row.account) == (" ", " 5 ")


def test_ascii_trimming(spark):
    line = {"LEDGER": " \u00a0X ", "AGENCYNBR": "\u00a0"}
    row = stage_one(spark, line, unicode_trim=False)
    assert (row.ledger, row.agency_nbr) == ("\u00a0X", "\u00a0")


def test_nonblank_fallback(spark):
    line = {
        "AGENCYNBR": " \u00a0",
        "OPERATING_UNIT": " 091 ",
        "AGENCYNAME": "  ",
        "OPERUNITDESCR": "\u00a0",
    }
    assert stage_one(spark, line) is None
    row = stage_one(spark, line, nonblank_fallback=True)
    assert (row.agency_nbr, row.agency_name) == ("091", "")
    assert stage_one(spark, {"AGENCYNBR": None}, nonblank_fallback=True) is None
