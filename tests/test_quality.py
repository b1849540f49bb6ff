from __future__ import annotations

import json
import math
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerspark import operators as op
from ledgerspark.operators import quality as q
from ledgerspark.operators.quality import MIN_BETWEEN, NOT_NULL, ContractField
from ledgerspark.plans import GOLD_SUITE, LEDGER_CONTRACT, SILVER_SUITE
from ledgerspark.plans.suites import FUND_MART_SUITE, KPI_SUITE, SILVER_STORED_SUITE


def run(df, *expectations):
    results = op.run_suite(df, list(expectations)).collect()
    return [(r.success, r.unexpected_count) for r in results]


def test_suite_sizes():
    assert (len(SILVER_SUITE), len(GOLD_SUITE)) == (11, 20)


def test_mostly(spark):
    good, bad = [(1,)] * 95, [(99,)] * 5
    check = q.Expectation(q.IN_SET, "v", values=(1, 2, None), mostly=0.95)
    passing = spark.createDataFrame(good + bad + [(None,)] * 50, "v int")
    failing = spark.createDataFrame(good[1:] + bad + [(99,)] + [(None,)] * 50, "v int")
    assert run(passing, check) == [(True, 5)]
    assert run(failing, check) == [(False, 6)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "v int, k string")
    assert run(
        df,
        q.Expectation(q.NOT_NULL, "v"),
        q.Expectation(q.IN_SET, "v", values=(1,)),
        q.Expectation(q.MIN_BETWEEN, "v", min_value=0),
        q.Expectation(q.UNIQUE, "k"),
    ) == [(True, 0), (True, 0), (False, None), (True, 0)]


def test_unique_counts_every_member(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    result = op.run_suite(df, [q.Expectation(q.UNIQUE, "k")]).collect()[0]
    assert (result.success, result.unexpected_count, result.element_count) == (False, 3, 6)


def test_bounds(spark):
    df = spark.createDataFrame([(D("1.00"),), (D("5.00"),), (None,)], "v decimal(18,2)")
    expectations = [
        q.Expectation(q.MIN_BETWEEN, "v", min_value=1),
        q.Expectation(q.MIN_BETWEEN, "v", min_value=1, strict=True),
        q.Expectation(q.MAX_BETWEEN, "v", max_value=5),
        q.Expectation(q.VALUES_BETWEEN, "v", min_value=0, max_value=4),
        q.Expectation(q.EQUAL_TO, "v", expression="5"),
        q.Expectation(q.EXPRESSION, "positive", expression="v > 0"),
    ]
    results = op.run_suite(df, expectations).collect()
    assert [r.success for r in results] == [True, False, True, False, False, True]
    assert [r.unexpected_count for r in results] == [None, None, None, 1, 1, 0]
    assert results[0].observed_value == "1.00"
    assert {r.element_count for r in results} == {3}


def test_missing_column_fails(spark):
    df = spark.createDataFrame([(1,)], "v int")
    results = op.run_suite(
        df, [q.Expectation(k, "w") for k in (q.EXISTS, q.NOT_NULL, q.UNIQUE)]
    ).collect()
    assert [r.success for r in results] == [False, False, False]


def test_statistics_failures_and_gate(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    suite = [q.Expectation(q.EXISTS, "v"), q.Expectation(q.NOT_NULL, "v")]
    saved = op.write_results(op.run_suite(df, suite), str(tmp_path / "results"))
    assert tuple(op.statistics(saved).collect()[0]) == (2, 1, 1, 50.0)
    assert [r.expectation for r in op.failures(saved).collect()] == [q.NOT_NULL]
    op.gate(saved.where("success"))
    with pytest.raises(op.SuiteFailed, match="silver: 1 failed") as caught:
        op.gate(saved, "silver")
    assert caught.value.failed[0].column == "v"
    text = "".join(p.read_text() for p in (tmp_path / "results").glob("*.json"))
    assert text.count('"expectation"') == 2


def test_contract(spark):
    columns = [f.name for f in LEDGER_CONTRACT]
    data = [("1.5", "2024", "5", None, "v", "t", "f", 1), (None, "1999", "1", "d", "v", "t", "f", 2)]
    df = spark.createDataFrame(data, [*columns, "extra"])
    fitted = op.apply_contract(df, LEDGER_CONTRACT)
    assert fitted.dtypes[:3] == [("amount", "double"), ("fiscal_year", "int"), ("quarter", "int")]
    assert fitted.columns == columns
    bad = {
        (r.expectation, r.column): r.unexpected_count
        for r in op.contract_violations(df, LEDGER_CONTRACT).collect()
        if not r.success
    }
    assert bad == {
        (q.NOT_NULL, "amount"): 1,
        (q.VALUES_BETWEEN, "fiscal_year"): 1,
        (q.VALUES_BETWEEN, "quarter"): 1,
    }
    with pytest.raises(ValueError, match="vendor_name"):
        op.apply_contract(df.drop("vendor_name"), LEDGER_CONTRACT)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        op.apply_contract(df.withColumn("quarter", df.fund_code), LEDGER_CONTRACT).collect()


def test_rows_and_failure_cases_of_a_contract(spark):
    rows = [
        ("a", "1.5", "2024", 1, "d"), ("b", "x", "FY24", 5, None), ("c", None, None, None, None),
        (None, "2", "1999", 4, ""), ("a", "3", "2051", 0, "d"),
    ]
    df = spark.createDataFrame(rows, "id string, amount string, fiscal_year string, quarter int, rule string")
    contract = [ContractField("amount", "double"), ContractField("fiscal_year", "int", ge=2000, le=2050),
                ContractField("quarter", "int", ge=1, le=4), ContractField("rule", "string", nullable=True)]
    accepted, cases = op.split_by_contract(df, contract, "id")
    assert [tuple(r) for r in accepted.collect()] == [(1.5, 2024, 1, "d")]
    assert sorted(map(tuple, cases.collect()), key=str) == sorted([
        ("b", "amount", "type double", "x"), ("b", "fiscal_year", "type int", "FY24"), ("b", "quarter", "<= 4", "5"),
        ("c", "amount", "not null", None), ("c", "fiscal_year", "not null", None), ("c", "quarter", "not null", None),
        (None, "fiscal_year", ">= 2000", "1999"), ("a", "fiscal_year", "<= 2050", "2051"), ("a", "quarter", ">= 1", "0"),
    ], key=str)
    with pytest.raises(ValueError, match="amount"):
        op.split_by_contract(df.drop("amount"), contract, "id")
    nothing = op.split_by_contract(df.limit(0), contract, "id")
    assert [x.count() for x in nothing] == [0, 0]


@pytest.mark.parametrize("suite", [SILVER_SUITE, SILVER_STORED_SUITE, GOLD_SUITE, KPI_SUITE, FUND_MART_SUITE])
def test_suites_as_json(spark, tmp_path, suite):
    assert op.suite_from_json(op.suite_to_json(suite, "s")) == suite
    op.write_suite(spark, suite, str(tmp_path / "s"), "s")
    assert op.read_suite(spark, str(tmp_path / "s")) == suite


def test_json_that_cannot_be_run():
    def text(kind, **kwargs):
        return json.dumps({"expectations": [{"expectation_type": kind, "kwargs": kwargs}]})

    for bad in (text("expect_magic", column="a"), text(NOT_NULL, column="a", regex="x"),
                text(MIN_BETWEEN, column="a", strict_min=True, strict_max=False)):
        with pytest.raises(ValueError, match="expect_"):
            op.suite_from_json(bad)


def test_fingerprints_that_meet_by_chance(spark, monkeypatch):
    # All values share one fingerprint; the counts stay exact.
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,), ("c",), ("d",), ("d",), ("d",)], "v string")
    unique = q.Expectation(q.UNIQUE, "v")
    assert sorted(map(tuple, op.duplicate_values(df, "v").collect())) == [("b", 2), ("d", 3)]
    monkeypatch.setattr(F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    assert sorted(map(tuple, op.duplicate_values(df, "v").collect())) == [("b", 2), ("d", 3)]
    assert run(df, unique) == [(False, 5)]
    assert run(df.where("v = 'c'"), unique) == run(df.limit(0), unique) == [(True, 0)]


def test_merged_profile(spark):
    rows = [(k % 3, float(k % 100), f"w{k % 7}" if k % 10 else None, k) for k in range(3000)]
    rows += [(None, None, "w1", None), (None, math.nan, "", 5), (3, None, None, None)]
    df = spark.createDataFrame(rows, "g int, x double, t string, n long").repartition(5)
    sketches = op.profile_sketches(df, ["g"])
    halves = [sketches.where("g = 0"), sketches.where("g is null or g <> 0")]
    merged = op.merge_profiles(halves[0].unionByName(halves[1]), df.schema.fields[1:])
    x, t, n = (r.asDict() for r in merged.collect())
    assert (x["row_count"], x["null_count"], x["zeros"], x["min"]) == (3003, 2, 30, "0.0")
    assert x["mean"] == pytest.approx(49.5) and x["stddev"] == pytest.approx(28.87, abs=0.01)
    assert abs(x["median"] - 50) <= 2 and abs(x["q95"] - 95) <= 2 and x["frequent"] is None
    assert (t["null_count"], t["shortest"], t["longest"], t["distinct_estimate"]) == (301, 0, 2, 8)
    assert t["frequent"][0].item == "w1" and t["frequent"][0]["count"] >= 380 and t["mean"] is None
    assert (n["min"], n["max"]) == ("0", "2999") and abs(n["distinct_estimate"] - 3000) < 150
    assert abs(n["q25"] - 750) < 60
    empty = op.profile_sketches(df.limit(0), ["g"])
    assert op.merge_profiles(empty, df.schema.fields[1:]).collect() == []
