from ledgerspark.plans.dims import (
    DIMENSIONS,
    build_dimension,
    dim_accounts,
    dim_agencies,
    dim_departments,
    dim_funds,
    dim_programs,
    dim_time,
)
from ledgerspark.plans.facts import fct_transactions, transactions_decorated
from ledgerspark.plans.marts import (
    budget_variance,
    budget_variance_conformed,
    completeness_scaffold,
    deal_size,
    department_spend_monthly,
    filtered_rollup,
    kpi_monthly_summary,
    mart_agency_fund_year,
    mart_base,
    mart_fund_year_period,
    missing_period_rows,
    revenue_by_department,
    variance_vs_prior_month,
)
from ledgerspark.plans.pipeline import build_gold, build_silver, run_pipeline
from ledgerspark.plans.staging import RAW_COLUMNS, stage_ledger
from ledgerspark.plans.suites import GOLD_SUITE, LEDGER_CONTRACT, SILVER_SUITE

__all__ = [
    "DIMENSIONS",
    "GOLD_SUITE",
    "LEDGER_CONTRACT",
    "RAW_COLUMNS",
    "SILVER_SUITE",
    "budget_variance",
    "budget_variance_conformed",
    "build_dimension",
    "build_gold",
    "build_silver",
    "completeness_scaffold",
    "deal_size",
    "department_spend_monthly",
    "dim_accounts",
    "dim_agencies",
    "dim_departments",
    "dim_funds",
    "dim_programs",
    "dim_time",
    "fct_transactions",
    "filtered_rollup",
    "kpi_monthly_summary",
    "mart_agency_fund_year",
    "mart_base",
    "mart_fund_year_period",
    "missing_period_rows",
    "revenue_by_department",
    "run_pipeline",
    "stage_ledger",
    "transactions_decorated",
    "variance_vs_prior_month",
]
