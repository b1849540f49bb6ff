"""Published releases: runs over changed files equal full ones, failed runs publish nothing."""

from __future__ import annotations

import pytest
from test_pipeline import write_lines

from ledgerspark.operators import SuiteFailed
from ledgerspark.operators.quality import MAX_BETWEEN, Expectation
from ledgerspark.plans.releases import Part, latest, publish, published, run_release, source_name, with_years

TABLES = ["stg_ledger", "fct_transactions", "dim_agencies", "dim_accounts", "kpi_monthly_summary"]
TABLES += ["mart_fund_year_period", "mart_agency_fund_year", "int_department_spend_monthly"]
TABLES += ["int_variance_features", "mart_budget_variance_by_fund", "mart_completeness_scaffold"]


def contents(spark, out):
    tables = {name: published(spark, out, name) for name in TABLES}
    return {name: sorted(map(str, df.select(*sorted(df.columns)).collect())) for name, df in tables.items()}


def test_changed_files_only(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    write_lines(raw / "ledger_fy24_qtr1.csv", [{}, {"ROWID": "r2", "POSTED_TOTAL_AMT": "-4.00"}])
    write_lines(raw / "ledger_fy25_qtr1.csv", [{"FISCAL_YEAR": "2025"}, {"FISCAL_YEAR": "2024", "ROWID": "r9"}])
    write_lines(raw / "ledger_fy26_qtr1.csv", [{"FISCAL_YEAR": "2026", "ACCTDESCR": "Pay", "ACCOUNT": "6"}])
    first = run_release(spark, str(raw), out)
    assert run_release(spark, str(raw), out) == first == latest(spark, out)

    # One file changes, one is gone and one is new, which gives account 5 a second name in all years.
    write_lines(raw / "ledger_fy25_qtr1.csv", [{"FISCAL_YEAR": "2025", "POSTED_TOTAL_AMT": "7.00"}])
    second = run_release(spark, str(raw), out)
    assert [p.years for p in second.tables["stg_ledger"]] == [[2026], [2024, 2025]]
    assert [p.years for p in second.tables["fct_transactions"]] == [[2026], [2024, 2025]]
    (raw / "ledger_fy26_qtr1.csv").unlink()
    write_lines(raw / "ledger_fy23_qtr1.csv", [{"FISCAL_YEAR": "2023", "ACCTDESCR": "Salaries"}])
    third = run_release(spark, str(raw), out)
    assert [p.years for p in third.tables["stg_ledger"]] == [[2024, 2025], [2023, 2026]]
    assert [p.years for p in third.tables["fct_transactions"]] == [[2023, 2024, 2025, 2026]]
    whole = str(tmp_path / "whole")
    run_release(spark, str(raw), whole, incremental=False)
    assert contents(spark, out) == contents(spark, whole)


def test_failed_run_changes_nothing(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    with pytest.raises(FileNotFoundError):
        published(spark, out, "stg_ledger")
    write_lines(raw / "ledger_fy24_qtr1.csv", [{}])
    limit = [Expectation(MAX_BETWEEN, "amount", max_value=100)]
    release = run_release(spark, str(raw), out, silver_suite=limit)
    before = contents(spark, out)
    write_lines(raw / "ledger_fy24_qtr1.csv", [{"POSTED_TOTAL_AMT": "500.00"}])
    with pytest.raises(SuiteFailed):
        run_release(spark, str(raw), out, silver_suite=limit)
    assert latest(spark, out) == release and contents(spark, out) == before
    with pytest.raises(RuntimeError, match="published already"):
        publish(spark, out, release)
    assert run_release(spark, str(raw), out).number == 2
    assert contents(spark, out) != before


def test_parts_and_names():
    old = [Part("a", [2022, 2023]), Part("b", [2024])]
    assert with_years(old, "c", [2023, 2024]) == [Part("a", [2022]), Part("c", [2023, 2024])]
    assert with_years(old, "c", []) == old
    root = "file:/data/raw"
    assert source_name("file:///data/raw/ledger_fy24.csv", root) == "ledger_fy24.csv"
    assert source_name("/data/raw/file=x.csv/part-0001.csv", root) == "x.csv"
    assert source_name("hdfs://host/data/raw/y/x.csv/part-0001.csv", root) == "y/x.csv"


def test_rollups_by_department_share_one_job(spark, tmp_path):
    """Lines are written once, and rollups are kept by year; a year that is gone leaves no rows."""
    raw, out, whole = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "whole")
    raw.mkdir()
    write_lines(raw / "ledger_fy24_qtr1.csv", [{}, {"ROWID": "r2", "POSTED_TOTAL_AMT": "-4.00"}])
    write_lines(raw / "ledger_fy25_qtr1.csv", [{"FISCAL_YEAR": "2025"}])
    first = run_release(spark, str(raw), out)
    (raw / "ledger_fy25_qtr1.csv").unlink()
    second = run_release(spark, str(raw), out)
    run_release(spark, str(raw), whole)
    names = ["int_mart_base", "key_summary", "kpi_monthly_summary", "int_department_spend_monthly"]
    for name in names:
        assert first.tables[name][0].path.endswith(f"/gold/dealt/mart={name}")
        assert [p.years for p in second.tables[name]] == [[2024], [2025]]
        ours, plain = (published(spark, o, name) for o in (out, whole))
        assert ours.columns == plain.columns
        assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect())) != []
    assert not list((tmp_path / "out").glob("release-*/staged"))
    assert contents(spark, out) == contents(spark, whole)
