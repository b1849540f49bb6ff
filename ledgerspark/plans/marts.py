"""Marts on the transaction fact.

Each mart sums by surrogate key first and fetches names for the sums, so joins see
one row per group instead of one per transaction. A key with several names repeats
its group once per name, which gives the same totals as repeating the transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.aggregates import (
    MEASURES,
    grouped_sum,
    plan_vs_actual,
    regroup,
    signed_rollup,
    sums_by_sign,
)
from ledgerspark.operators.joins import Lookup, star_join, weighted_sum
from ledgerspark.operators.series import missing_periods, period_scaffold, prior_period_delta
from ledgerspark.plans.facts import name_lookups

SCAFFOLD_KEYS = ["fiscal_year", "fund_sk", "agency_sk"]
#: The keys of which every mart uses some.
BASE_KEYS = ["fiscal_year", "accounting_period", "agency_sk", "fund_sk", "department_sk", "account_sk", "ledger"]
#: Those that the large rollups share, by which the fact is dealt out once for all of them.
DEALT_BY = ["fiscal_year", "accounting_period", "department_sk"]
#: Lines of the fact that a task groups, several times over, when the base is written.
LINES_A_TASK = 250_000


def deal_size(lines: DataFrame) -> int:
    """Into how many tasks ``mart_base`` deals the lines of a written table, whatever the session's setting."""
    return lines.count() // LINES_A_TASK + 1


def mart_base(fact: DataFrame, partitions: int | None = None) -> DataFrame:
    """The fact summed by all mart keys and sign; written once, every mart rolls up from it.

    All marts below, and ``key_summary``, take it in place of the fact and give the same rows.
    Hardly any two lines share all keys, so lines are dealt out as they are instead of summed
    within each task first, which would hold a row per line of its split. As a plan it stays dealt
    out by department and month: what groups by these and more keys shuffles nothing again.
    ``partitions`` sets into how many, see ``deal_size``; without it the session's setting does, and
    Spark joins small ones, up to many more lines.
    """
    dealt = fact.repartition(*([partitions] if partitions else []), *DEALT_BY)
    return sums_by_sign(dealt, BASE_KEYS)


def _rollup(fact: DataFrame, by: list[str], **options: bool) -> DataFrame:
    return signed_rollup(fact, by, rows="rows" if "rows" in fact.columns else None, **options)


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("accounting_period", "month")


def kpi_monthly_summary(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Measures per year, month and department name.

    Departments that share a name are one group; rows without a department keep a
    group with NULL name.
    """
    by_key = _rollup(
        _with_month(fact), ["fiscal_year", "month", "department_sk"], inclusive_zero=False
    )
    names = Lookup(dims["dim_departments"], "department_sk", "department_sk", ["department_name"])
    group = ["fiscal_year", "month", "department_name"]
    return regroup(star_join(by_key, [names], [*group, *MEASURES]), group)


def mart_fund_year_period(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Measures per year, month and fund; rows without a fund are left out.

    A fund row is one (key, code, name), so the joined sums need no second grouping.
    """
    by_key = _rollup(_with_month(fact), ["fiscal_year", "month", "fund_sk"])
    funds = dims["dim_funds"].withColumnRenamed("fund_business_key", "fund_code")
    lookup = Lookup(funds, "fund_sk", "fund_sk", ["fund_code", "fund_name"])
    columns = ["fiscal_year", "month", "fund_code", "fund_name", *MEASURES]
    return star_join(by_key, [lookup], columns, "inner")


def mart_agency_fund_year(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Measures per year, agency and fund; rows without either are left out."""
    by_key = _rollup(fact, ["fiscal_year", "agency_sk", "fund_sk"])
    agencies = dims["dim_agencies"].withColumnRenamed("agency_business_key", "agency_id")
    funds = dims["dim_funds"].withColumnRenamed("fund_business_key", "fund_code")
    lookups = [
        Lookup(agencies, "agency_sk", "agency_sk", ["agency_id", "agency_name"]),
        Lookup(funds, "fund_sk", "fund_sk", ["fund_code", "fund_name"]),
    ]
    columns = ["fiscal_year", "agency_id", "agency_name", "fund_code", "fund_name", *MEASURES]
    return star_join(by_key, lookups, columns, "inner")


def department_spend_monthly(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Total per department and month over the decorated transactions."""
    return weighted_sum(
        _with_month(fact),
        name_lookups(dims),
        ["department_sk", "fiscal_year", "month"],
        "amount",
        "total_monthly_amount",
    )


def variance_vs_prior_month(monthly: DataFrame) -> DataFrame:
    """Change of a department's total against its previous month with data."""
    return prior_period_delta(
        monthly,
        ["department_sk"],
        ["fiscal_year", "month"],
        "total_monthly_amount",
        "variance_vs_prior_month",
    )


def budget_variance(fact: DataFrame) -> DataFrame:
    """Budget against actuals per year and fund; budget-only groups have NULL keys."""
    return plan_vs_actual(fact, ["fiscal_year", "fund_sk"])


def budget_variance_conformed(fact: DataFrame) -> DataFrame:
    """Budget against actuals with every group under its own keys."""
    return plan_vs_actual(fact, ["fiscal_year", "fund_sk"], keep_plan_keys=True)


def completeness_scaffold(fact: DataFrame) -> DataFrame:
    """Periods 1..12 for every year, fund and agency with data."""
    return period_scaffold(fact, SCAFFOLD_KEYS, "accounting_period")


def missing_period_rows(fact: DataFrame) -> DataFrame:
    """Scaffold rows without any transaction."""
    return missing_periods(fact, SCAFFOLD_KEYS, "accounting_period")


def revenue_by_department(kpi: DataFrame) -> DataFrame:
    """Revenue per year and department name, latest year first."""
    return grouped_sum(
        kpi, ["fiscal_year", "department_name"], "total_revenue", "total_revenue"
    ).orderBy(F.desc_nulls_last("fiscal_year"), F.asc_nulls_last("department_name"))


def filtered_rollup(
    fact: DataFrame,
    dims: dict[str, DataFrame],
    fiscal_year: int | None = None,
    fund_code: str | None = None,
    department: str | None = None,
) -> DataFrame:
    """Amount per year and department, narrowed by any of year, fund and department.

    Year and fund become filters of the fact scan (a partition filter and, as a fund
    key is the hash of its code, an equality on the key). Rows without a department
    keep a group with NULL name unless a department is asked for.
    """
    departments = dims["dim_departments"]
    if fiscal_year is not None:
        fact = fact.where(F.col("fiscal_year") == fiscal_year)
    if fund_code is not None:
        fact = fact.where(F.col("fund_sk") == F.md5(F.lit(fund_code)))
    if department is not None:
        departments = departments.where(F.col("department_name") == department)
        fact = fact.join(departments.select("department_sk"), "department_sk", "left_semi")
    sums = grouped_sum(fact, ["fiscal_year", "department_sk"], "amount", "total_amount")
    names = Lookup(departments, "department_sk", "department_sk", ["department_name"])
    group = ["fiscal_year", "department_name"]
    return grouped_sum(
        star_join(sums, [names], [*group, "total_amount"]), group, "total_amount", "total_amount"
    )
