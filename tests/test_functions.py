from __future__ import annotations

import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark import functions as fn
from ledgerspark.plans.staging import file_fiscal_quarter


def evaluate(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_safe_int(spark):
    cases = {
        "2022.0": 2022,
        "1.5": 2,
        "2.5": 2,
        "3.5": 4,
        "-0.5": 0,
        "1e3": 1000,
        " 7 ": 7,
        "\u00a07\u2003": 7,
        "7\u00a07": None,
        "": None,
        "   ": None,
        "abc": None,
        "nan": None,
        "inf": None,
        "-Infinity": None,
        "99999999999": None,
        "5d": None,
        "5f": None,
        "0x10": None,
        "0x1p3": None,
        "2_022": None,
        "+": None,
        ".": None,
        "1e400": None,
        None: None,
    }
    assert evaluate(spark, list(cases), fn.safe_int) == list(cases.values())


def test_money(spark):
    texts = ["2.345", "-0.005", " 2.5 ", None]
    rounded = [Decimal("2.35"), Decimal("-0.01"), Decimal("2.50"), None]
    assert evaluate(spark, texts, fn.money) == rounded
    clean = evaluate(spark, ["1,234.5", "$-7"], lambda c: fn.money(c, clean_currency=True))
    assert clean == [Decimal("1234.50"), Decimal("-7.00")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evaluate(spark, ["1,234.5"], fn.money)


def test_trim(spark):
    texts = ["\u00a0a", "\ta", "  a ", "   "]
    assert evaluate(spark, texts, fn.trim_text) == ["a", "\ta", "a", ""]
    ascii_only = evaluate(spark, texts, lambda c: fn.trim_text(c, unicode_trim=False))
    assert ascii_only == ["\u00a0a", "\ta", "a", ""]


def test_blank_to_null(spark):
    texts = [None, "", "  ", " a "]
    assert evaluate(spark, texts, fn.blank_to_null) == [None, None, None, "a"]
    kept = evaluate(spark, texts, lambda c: fn.blank_to_null(c, trim=False))
    assert kept == [None, None, "  ", " a "]


def test_fallback(spark):
    rows = [("  ", "z"), (None, "y"), ("x", "z"), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    pair = (F.col("a"), F.col("b"))
    blocked = fn.blank_to_null(fn.coalesce_trimmed(*pair), trim=False)
    got = df.select(blocked, fn.coalesce_nonblank(*pair)).collect()
    assert [tuple(r) for r in got] == [(None, "z"), ("y", "y"), ("x", "x"), (None, None)]


def test_period_labels(spark):
    df = spark.createDataFrame([(0,), (1,), (4,), (12,), (13,), (-1,), (None,)], "p int")
    got = df.select(fn.fiscal_quarter(F.col("p")), fn.fiscal_month_name(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [
        ("Q1", "Opening Balance"),
        ("Q1", "January"),
        ("Q2", "April"),
        ("Q4", "December"),
        ("Unknown", "Unknown"),
        ("Unknown", "Unknown"),
        ("Unknown", "Unknown"),
    ]


def test_surrogate_key(spark):
    rows = [("a", "b"), ("a", None), ("a-", "b"), ("a", "-b")]
    df = spark.createDataFrame(rows, "x string, y string")

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    plain = [r[0] for r in df.select(fn.surrogate_key("x", "y")).collect()]
    assert plain[:2] == ["8ca2ed590cf2ea2404f2e67641bcdf50", md5("a-")]
    assert plain[2] == plain[3] == md5("a--b")
    marked = df.select(fn.surrogate_key("x", "y", null_as_empty=False)).collect()[1][0]
    assert marked == md5("a-_dbt_utils_surrogate_key_null_")
    safe = [r[0] for r in df.select(fn.surrogate_key("x", "y", safe=True)).collect()]
    assert safe[2] != safe[3]


def test_file_fiscal_quarter(spark):
    paths = ["ledger_fy22_qtr1.csv", "a/ledger_fy22_qtr4.csv", "ledger_fy22.csv"]
    assert evaluate(spark, paths, file_fiscal_quarter) == [1, 4, None]
