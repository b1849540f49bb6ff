"""Expectation suites, rules and contract of the ledger models."""

from __future__ import annotations

from decimal import Decimal

from ledgerspark.operators.quality import (
    EQUAL_TO,
    EXISTS,
    EXPRESSION,
    IN_SET,
    MAX_BETWEEN,
    MIN_BETWEEN,
    NOT_NULL,
    UNIQUE,
    VALUES_BETWEEN,
    ContractField,
    Expectation,
)

BILLION = Decimal(10**9)

# Accepted sets, bounds and rules of the ledger.
FISCAL_YEARS = (2022, 2023, 2024, 2025, 2026)
LEDGERS = ("ACTUALS", "BUDGET", "ENCUMBRANCE", "APPROPRIATION")
FILE_QUARTERS = (1, 2, 3, 4)
MONTHS = (*range(1, 13), None)
ALLOWED_ACCOUNTS = {"019000": ["531110", "531120"], "021000": ["552110"]}
ALLOWED_ACCOUNT_NAMES = {
    "Highway Fund SK": ["Asphalt", "Concrete", "Salaries"],
    "Education Fund SK": ["Textbooks", "Computers"],
}
NET_BALANCE = "round(total_revenue + total_expenses, 2) = round(net_amount, 2)"

SILVER_SUITE = [
    *[Expectation(EXISTS, c) for c in ("ledger_sk", "amount", "fiscal_year", "ledger")],
    Expectation(NOT_NULL, "ledger_sk"),
    Expectation(NOT_NULL, "amount"),
    Expectation(UNIQUE, "ledger_sk"),
    Expectation(IN_SET, "fiscal_year", values=FISCAL_YEARS),
    Expectation(IN_SET, "ledger", values=LEDGERS),
    Expectation(MIN_BETWEEN, "amount", min_value=-20 * BILLION),
    Expectation(MAX_BETWEEN, "amount", max_value=20 * BILLION),
]

# The first nine checks without the bounds are the stored form of the silver suite.
SILVER_STORED_SUITE = SILVER_SUITE[:9]

SILVER_COLUMN_SUITE = [
    Expectation(UNIQUE, "ledger_sk"),
    *[
        Expectation(NOT_NULL, c)
        for c in (
            "ledger_sk",
            "amount",
            "fiscal_year",
            "file_fiscal_quarter",
            "ledger",
            "agency_nbr",
            "account",
            "dept_id",
        )
    ],
    Expectation(IN_SET, "fiscal_year", values=FISCAL_YEARS),
    Expectation(IN_SET, "file_fiscal_quarter", values=FILE_QUARTERS),
    Expectation(IN_SET, "ledger", values=LEDGERS),
]

KPI_COLUMNS = (
    "fiscal_year",
    "month",
    "department_name",
    "total_revenue",
    "total_expenses",
    "net_amount",
    "transaction_count",
)

GOLD_SUITE = [
    *[Expectation(EXISTS, c) for c in KPI_COLUMNS],
    *[
        Expectation(NOT_NULL, c)
        for c in ("fiscal_year", "month", "department_name", "net_amount")
    ],
    Expectation(IN_SET, "fiscal_year", values=FISCAL_YEARS),
    Expectation(IN_SET, "month", values=MONTHS, mostly=0.95),
    Expectation(MIN_BETWEEN, "total_revenue", min_value=-100 * BILLION),
    Expectation(MAX_BETWEEN, "total_revenue", max_value=100 * BILLION),
    Expectation(MIN_BETWEEN, "total_expenses", min_value=-2000 * BILLION),
    Expectation(MAX_BETWEEN, "total_expenses", max_value=100 * BILLION),
    Expectation(VALUES_BETWEEN, "transaction_count", min_value=0, max_value=1_000_000),
    Expectation(MIN_BETWEEN, "net_amount", min_value=-2000 * BILLION),
    Expectation(MAX_BETWEEN, "net_amount", max_value=200 * BILLION),
]

KPI_SUITE = [
    *[Expectation(EXISTS, c) for c in KPI_COLUMNS],
    *[Expectation(NOT_NULL, c) for c in ("fiscal_year", "month", "net_amount")],
    Expectation(IN_SET, "month", values=tuple(range(1, 13))),
    Expectation(MIN_BETWEEN, "total_expenses", min_value=-50 * BILLION),
    Expectation(MAX_BETWEEN, "total_revenue", max_value=50 * BILLION),
    Expectation(EQUAL_TO, "net_amount", expression="total_revenue + total_expenses"),
]

FACT_SUITE = [Expectation(NOT_NULL, "amount")]


def _mart_suite(*keys: str) -> list[Expectation]:
    balance = Expectation(EXPRESSION, "net_amount", expression=NET_BALANCE)
    return [*[Expectation(NOT_NULL, k) for k in keys], balance]


FUND_MART_SUITE = _mart_suite("fiscal_year", "month", "fund_code")
AGENCY_MART_SUITE = _mart_suite("fiscal_year", "agency_id", "fund_code")

LEDGER_CONTRACT = [
    ContractField("amount", "double"),
    ContractField("fiscal_year", "int", ge=2000, le=2050),
    ContractField("quarter", "int", ge=1, le=4),
    ContractField("department_name", "string", nullable=True),
    ContractField("vendor_name", "string", nullable=True),
    ContractField("transaction_description", "string", nullable=True),
    ContractField("fund_code", "string", nullable=True),
]
