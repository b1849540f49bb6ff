"""Dimension tables: distinct members of the silver ledger with hashed keys."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions import fiscal_month_name, fiscal_quarter, surrogate_key


@dataclass(frozen=True)
class Dimension:
    """Which silver columns form a dimension and what they are called there."""

    sk: str
    key: str
    key_name: str
    description: str | None = None
    name: str | None = None


DIMENSIONS = {
    "dim_agencies": Dimension(
        "agency_sk", "agency_nbr", "agency_business_key", "agency_name", "agency_name"
    ),
    "dim_funds": Dimension("fund_sk", "fund_code", "fund_business_key", "fund_descr", "fund_name"),
    "dim_departments": Dimension(
        "department_sk", "dept_id", "department_business_key", "dept_descr", "department_name"
    ),
    "dim_accounts": Dimension(
        "account_sk", "account", "account_business_key", "acct_descr", "account_name"
    ),
    "dim_programs": Dimension("program_sk", "program_code", "program_business_key"),
}


def build_dimension(silver: DataFrame, spec: Dimension) -> DataFrame:
    """Distinct (key, description) pairs with both present.

    The surrogate key hashes the key alone, so a key with several descriptions has
    several rows; ``one_name_per_key`` keeps one.
    """
    source = [c for c in (spec.key, spec.description) if c]
    members = silver.select(*source).dropna().distinct()
    named = [F.col(spec.key).alias(spec.key_name)]
    if spec.description:
        named.append(F.col(spec.description).alias(spec.name))
    return members.select(surrogate_key(spec.key).alias(spec.sk), *named)


def codes_with_several_names(dims: dict[str, DataFrame]) -> DataFrame:
    """(dimension, code, names) for business keys that have more than one name."""
    parts = [
        dims[table]
        .groupBy(F.col(spec.key_name).alias("code"))
        .agg(F.count(F.lit(1)).alias("names"))
        .where("names > 1")
        .select(F.lit(table).alias("dimension"), "code", "names")
        for table, spec in DIMENSIONS.items()
        if spec.name and table in dims
    ]
    return reduce(DataFrame.unionByName, parts)


def dim_agencies(silver: DataFrame) -> DataFrame:
    return build_dimension(silver, DIMENSIONS["dim_agencies"])


def dim_funds(silver: DataFrame) -> DataFrame:
    return build_dimension(silver, DIMENSIONS["dim_funds"])


def dim_departments(silver: DataFrame) -> DataFrame:
    return build_dimension(silver, DIMENSIONS["dim_departments"])


def dim_accounts(silver: DataFrame) -> DataFrame:
    return build_dimension(silver, DIMENSIONS["dim_accounts"])


def dim_programs(silver: DataFrame) -> DataFrame:
    """Program codes; an empty code is a member, as staging keeps it."""
    return build_dimension(silver, DIMENSIONS["dim_programs"])


def dim_time(silver: DataFrame) -> DataFrame:
    """Fiscal years and periods with quarter and period name, in order."""
    periods = silver.select("fiscal_year", "accounting_period").dropna().distinct()
    return periods.select(
        surrogate_key("fiscal_year", "accounting_period").alias("time_sk"),
        F.col("fiscal_year").alias("time_business_key"),
        "accounting_period",
        fiscal_quarter(F.col("accounting_period")).alias("fiscal_quarter"),
        fiscal_month_name(F.col("accounting_period")).alias("fiscal_month_name"),
    ).orderBy("time_business_key", "accounting_period")
