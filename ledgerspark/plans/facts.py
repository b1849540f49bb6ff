"""The transaction fact and its view with names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.joins import Lookup, decorate, star_join

FACT_COLUMNS = [
    "agency_sk",
    "fund_sk",
    "department_sk",
    "account_sk",
    "account_name",
    "ledger",
    "project_id",
    "budget_ref",
    "amount",
    "fiscal_year",
    "accounting_period",
]


def fact_lookups(dims: dict[str, DataFrame]) -> list[Lookup]:
    """Business key to surrogate key, for the four joined dimensions.

    Departments come first: they are the most, and once Spark shuffles for them, lines should not
    yet carry other keys or be repeated by other names.
    """
    return [
        Lookup(dims["dim_departments"], "dept_id", "department_business_key", ["department_sk"]),
        Lookup(dims["dim_agencies"], "agency_nbr", "agency_business_key", ["agency_sk"]),
        Lookup(dims["dim_funds"], "fund_code", "fund_business_key", ["fund_sk"]),
        Lookup(
            dims["dim_accounts"], "account", "account_business_key", ["account_sk", "account_name"]
        ),
    ]


def name_lookups(dims: dict[str, DataFrame]) -> list[Lookup]:
    """Surrogate key to name, for the four joined dimensions."""
    return [
        Lookup(dims["dim_agencies"], "agency_sk", "agency_sk", ["agency_name"]),
        Lookup(dims["dim_funds"], "fund_sk", "fund_sk", ["fund_name"]),
        Lookup(dims["dim_departments"], "department_sk", "department_sk", ["department_name"]),
        Lookup(dims["dim_accounts"], "account_sk", "account_sk", ["account_name"]),
    ]


def fct_transactions(silver: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Ledger rows with surrogate keys for agency, fund, department and account.

    ``dims`` should be written tables, see ``operators.joins``. A code with several
    names repeats its ledger rows once per name.
    """
    return star_join(silver, fact_lookups(dims), FACT_COLUMNS)


def transactions_decorated(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows with the four names; codes with several names repeat rows again."""
    keys = ["agency_sk", "fund_sk", "department_sk", "account_sk"]
    names = ["agency_name", "fund_name", "department_name", "account_name"]
    measures = ["amount", "fiscal_year", F.col("accounting_period").alias("month")]
    return decorate(fact.drop("account_name"), name_lookups(dims), [*keys, *names, *measures])
