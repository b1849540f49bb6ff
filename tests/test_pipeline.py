"""Raw files to gold on a small hand-written ledger."""

from __future__ import annotations

import csv
from decimal import Decimal as D

import pytest

from ledgerspark.operators import SuiteFailed
from ledgerspark.plans import RAW_COLUMNS, filtered_rollup, run_pipeline, stage_ledger
from ledgerspark.plans.pipeline import WARN_ONLY, TestsFailed, build_gold, mart_plans, model_tests, run_tests
from ledgerspark.sources import materialize, read_ledger_csv, register_views, targets_frame

LINE = {
    "AGENCYNBR": "090",
    "AGENCYNAME": "Finance",
    "LEDGER": "ACTUALS",
    "FISCAL_YEAR": "2024",
    "ACCOUNTING_PERIOD": "1",
    "FUND_CODE": "100",
    "FUNDDESCR": "General",
    "DEPTID": "D1",
    "DEPTDESCR": "Payroll",
    "ACCOUNT": "5",
    "ACCTDESCR": "Wages",
    "POSTED_TOTAL_AMT": "10.00",
    "ROWID": "r1",
}


def write_lines(path, lines):
    with path.open("w", newline="") as f:
        writer = csv.DictWriter(f, RAW_COLUMNS, restval="")
        writer.writeheader()
        writer.writerows([{**LINE, **line} for line in lines])


@pytest.fixture
def raw_root(tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    write_lines(
        root / "ledger_fy24_qtr1.csv",
        [
            {},
            {"ROWID": "r2", "POSTED_TOTAL_AMT": "-4.00", "DEPTDESCR": "Pay roll"},
            {"ROWID": "r3", "LEDGER": "BUDGET", "FUND_CODE": "200", "FUNDDESCR": "Roads"},
            {"ROWID": "r4", "AGENCYNBR": "", "OPERATING_UNIT": " 091 ", "AGENCYNAME": ""},
            {"ROWID": "r5", "AGENCYNBR": "  ", "OPERATING_UNIT": "092"},
            {"ROWID": "r6", "ACCOUNT": ""},
            {"ROWID": "r7", "FISCAL_YEAR": "n/a"},
        ],
    )
    return root


def test_staging(spark, raw_root):
    raw = read_ledger_csv(spark, str(raw_root), RAW_COLUMNS)
    silver = {r.row_id: r for r in stage_ledger(raw, with_file_quarter=True).collect()}
    assert sorted(silver) == ["r1", "r2", "r3", "r4"]
    assert (silver["r4"].agency_nbr, silver["r4"].agency_name) == ("091", None)
    assert (silver["r1"].fiscal_year, silver["r1"].amount) == (2024, D("10.00"))
    assert silver["r1"].file_fiscal_quarter == 1
    assert silver["r1"].source_path == "ledger_fy24_qtr1.csv"
    assert len({r.ledger_sk for r in silver.values()}) == 4
    fixed = stage_ledger(raw, nonblank_fallback=True).collect()
    assert {r.row_id: r.agency_nbr for r in fixed}["r5"] == "092"


def test_pipeline(spark, raw_root, tmp_path):
    targets = targets_frame(
        spark,
        [("total_revenue", 2024, D("50.00")), ("total_expenses", 2024, D("-8.00"))],
    )
    gold, tests = run_pipeline(spark, str(raw_root), str(tmp_path / "out"), targets=targets)
    # Department D1 has two names, so each of the four ledger lines appears twice.
    assert gold.fact.count() == 8
    kpi = {r.department_name: r for r in gold.marts["kpi_monthly_summary"].collect()}
    # Joining the names to the fact repeats them once more.
    assert (kpi["Payroll"].total_revenue, kpi["Payroll"].transaction_count) == (D("60.00"), 8)
    funds = {r.fund_code: r for r in gold.marts["mart_fund_year_period"].collect()}
    assert (funds["100"].net_amount, funds["200"].transaction_count) == (D("32.00"), 2)
    agencies = gold.marts["mart_agency_fund_year"].collect()
    assert {r.agency_id for r in agencies} == {"090"}
    spend = gold.marts["int_department_spend_monthly"].collect()
    assert [r.total_monthly_amount for r in spend] == [D("104.00")]
    decorated = gold.marts["int_transactions_joined_to_dims"]
    assert decorated.groupBy().sum("amount").collect()[0][0] == D("104.00")

    out = tmp_path / "out"
    assert len(list((out / "gold").iterdir())) == 15  # the joined transactions stay a plan
    saved = {r.test: r.violations for r in spark.read.json(f"{out}/validation/models").collect()}
    assert saved["period_completeness"] == 33
    names = spark.read.json(f"{out}/validation/names").collect()
    assert [(r.dimension, r.code, r.names) for r in names] == [("dim_departments", "D1", 2)]
    assert spark.read.parquet(f"{out}/silver/stg_ledger").count() == 4
    assert spark.read.parquet(f"{out}/gold/mart_completeness_scaffold").count() == 36
    assert any((out / "validation" / "gold").glob("*.json"))

    violations = {name: df.count() for name, df in tests.items()}
    assert violations.pop("period_completeness") == 33
    assert violations.pop("reconciliation") == 1
    assert set(violations.values()) == {0}

    register_views({"fct_transactions": gold.fact, **gold.dims, **gold.marts})
    by_year = spark.sql(
        "SELECT fiscal_year, department_name, SUM(total_revenue) AS revenue "
        "FROM kpi_monthly_summary GROUP BY 1, 2 ORDER BY 1 DESC, 2"
    ).collect()
    assert [(r.department_name, r.revenue) for r in by_year] == [
        ("Pay roll", D("60.00")),
        ("Payroll", D("60.00")),
    ]
    one_year = spark.sql(
        "SELECT department_sk, SUM(amount) AS total FROM fct_transactions "
        "WHERE fiscal_year = :year GROUP BY 1",
        args={"year": 2024},
    ).collect()
    assert [r.total for r in one_year] == [D("52.00")]
    kept = filtered_rollup(gold.fact, gold.dims, 2024, "100", "Payroll").collect()
    assert [(r.department_name, r.total_amount) for r in kept] == [("Payroll", D("32.00"))]


def test_gate_stops_before_gold(spark, raw_root, tmp_path):
    write_lines(raw_root / "ledger_fy24_qtr2.csv", [{"ROWID": "r8", "LEDGER": "OTHER"}])
    with pytest.raises(SuiteFailed, match="expect_column_values_to_be_in_set"):
        run_pipeline(spark, str(raw_root), str(tmp_path / "out"))
    assert (tmp_path / "out" / "silver").exists()
    assert not (tmp_path / "out" / "gold").exists()


def test_bad_amount_fails_the_job(spark, raw_root):
    write_lines(raw_root / "ledger_fy24_qtr2.csv", [{"POSTED_TOTAL_AMT": "1,234.5"}])
    raw = read_ledger_csv(spark, str(raw_root), RAW_COLUMNS)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage_ledger(raw).collect()
    cleaned = stage_ledger(raw, clean_currency=True).collect()
    assert D("1234.50") in {r.amount for r in cleaned}


def test_one_row_per_line(spark, raw_root, tmp_path):
    write_lines(raw_root / "ledger_fy24_qtr2.csv", [{"ROWID": "r9"}, {"ROWID": "r9"}])
    out = str(tmp_path / "out")
    with pytest.raises(SuiteFailed, match="unique"):
        run_pipeline(spark, str(raw_root), out)
    gold, _ = run_pipeline(spark, str(raw_root), out, dedupe=True, one_name=True)
    assert gold.fact.count() == 5
    assert gold.marts["kpi_monthly_summary"].agg({"transaction_count": "sum"}).first()[0] == 5


def test_broken_rule_stops_the_run(spark, raw_root, tmp_path):
    write_lines(raw_root / "ledger_fy24_qtr2.csv", [{"ROWID": "r8", "FUND_CODE": "019000"}])
    with pytest.raises(TestsFailed, match="allowed_account_for_fund: 1"):
        run_pipeline(spark, str(raw_root), str(tmp_path / "out"))
    run_pipeline(
        spark, str(raw_root), str(tmp_path / "out"), silver_suite=[], gold_suite=[],
        warn_only=(*WARN_ONLY, "allowed_account_for_fund"),
    )


def test_broken_foreign_key_is_found(spark, raw_root, tmp_path):
    gold, _ = run_pipeline(spark, str(raw_root), str(tmp_path / "out"))
    silver = spark.read.parquet(f"{tmp_path}/out/silver/stg_ledger")
    gold.dims["dim_funds"] = gold.dims["dim_funds"].where("fund_business_key != '200'")
    with pytest.raises(TestsFailed, match="relationships_fund_sk: 1"):
        run_tests(model_tests(silver, gold), f"{tmp_path}/tests")


def test_marts_read_the_base_only(spark, raw_root, tmp_path):
    raw = read_ledger_csv(spark, str(raw_root), RAW_COLUMNS)
    silver = materialize(stage_ledger(raw), str(tmp_path / "silver"))
    gold = build_gold(silver, str(tmp_path / "gold"))
    from_fact = mart_plans(gold.fact, gold.dims)
    assert gold.base.count() < gold.fact.count()
    for name, mart in gold.marts.items():
        own = sorted(map(str, mart.select(*sorted(mart.columns)).collect()))
        assert own == sorted(map(str, from_fact[name].select(*sorted(mart.columns)).collect())), name
        reads_fact = any("/fct_transactions/" in f for f in mart.inputFiles())
        assert reads_fact == (name == "int_transactions_joined_to_dims"), name


def test_rejected_lines_are_kept(spark, raw_root, tmp_path):
    with (raw_root / "ledger_fy24_qtr1.csv").open("a") as f:
        f.write("too,short\n")
    run_pipeline(spark, str(raw_root), str(tmp_path / "out"), silver_suite=[], gold_suite=[])
    rejects = spark.read.parquet(f"{tmp_path}/out/validation/rejects").collect()
    assert [tuple(r) for r in rejects] == [("ledger_fy24_qtr1.csv", "too,short", "2 of 36 fields")]
