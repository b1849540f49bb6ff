"""Raw files to exported gold tables, stopping when a quality gate fails."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.aggregates import money_sum
from ledgerspark.operators.joins import dedupe_on_key, one_name_per_key, orphan_rows
from ledgerspark.operators.quality import Expectation, failures, gate, run_suite, write_results
from ledgerspark.operators.rules import allowed_pairs, reconcile
from ledgerspark.plans import dims as d
from ledgerspark.plans import marts as m
from ledgerspark.plans.facts import fct_transactions, transactions_decorated
from ledgerspark.plans.staging import RAW_COLUMNS, file_fiscal_quarter, stage_ledger
from ledgerspark.plans.suites import (
    AGENCY_MART_SUITE,
    ALLOWED_ACCOUNT_NAMES,
    ALLOWED_ACCOUNTS,
    FACT_SUITE,
    FUND_MART_SUITE,
    GOLD_SUITE,
    SILVER_COLUMN_SUITE,
    SILVER_SUITE,
)
from ledgerspark.sources.csv_files import declared_columns, ledger_files
from ledgerspark.sources.tables import CONCURRENT_WRITES, materialize, write_table

DIM_BUILDERS = {
    "dim_agencies": d.dim_agencies,
    "dim_funds": d.dim_funds,
    "dim_departments": d.dim_departments,
    "dim_accounts": d.dim_accounts,
    "dim_programs": d.dim_programs,
    "dim_time": d.dim_time,
}


@dataclass
class Gold:
    """Written dimensions, fact and mart base, and the marts as plans over them."""

    dims: dict[str, DataFrame]
    fact: DataFrame
    marts: dict[str, DataFrame]
    base: DataFrame | None = None


def build_silver(
    raw: DataFrame, path: str, rebalance: bool = True, dedupe: bool = False, **options: bool
) -> DataFrame:
    """Stage the raw rows and write them by fiscal year.

    Rows are gathered by year before the write, else every input split would write its own
    file per year. ``rebalance=False`` saves that shuffle where files are few. ``dedupe``
    keeps one line per ``ledger_sk``, the least by row number and amount.
    """
    silver = stage_ledger(raw, **options)
    if dedupe:
        silver = dedupe_on_key(silver, "ledger_sk", ["row_id", "amount"])
    return materialize(silver, path, "fiscal_year", rebalance)


def build_dims(silver: DataFrame, path: str, one_name: bool = False) -> dict[str, DataFrame]:
    """Write all dimensions, several at a time; each reads its own columns only.

    ``one_name`` keeps the first name of a code, so that the fact has one row per line.
    """

    def build(name: str) -> DataFrame:
        dim, spec = DIM_BUILDERS[name](silver), d.DIMENSIONS.get(name)
        if one_name and spec and spec.name:
            dim = one_name_per_key(dim, spec.key_name, spec.name)
        return materialize(dim, f"{path}/{name}")

    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        return dict(zip(DIM_BUILDERS, pool.map(build, DIM_BUILDERS), strict=True))


def build_fact(silver: DataFrame, dims: dict[str, DataFrame], path: str) -> DataFrame:
    """Write the fact by fiscal year; it inherits the silver layout."""
    return materialize(fct_transactions(silver, dims), f"{path}/fct_transactions", "fiscal_year")


def mart_plans(
    fact: DataFrame, dims: dict[str, DataFrame], base: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All marts as plans; with ``base``, a written ``mart_base``, none but the joined rows reads the fact."""
    joined = transactions_decorated(fact, dims)
    fact = fact if base is None else base
    monthly = m.department_spend_monthly(fact, dims)
    return {
        "int_transactions_joined_to_dims": joined,
        "int_department_spend_monthly": monthly,
        "int_variance_features": m.variance_vs_prior_month(monthly),
        "kpi_monthly_summary": m.kpi_monthly_summary(fact, dims),
        "mart_fund_year_period": m.mart_fund_year_period(fact, dims),
        "mart_agency_fund_year": m.mart_agency_fund_year(fact, dims),
        "mart_budget_variance_by_fund": m.budget_variance(fact),
        "mart_completeness_scaffold": m.completeness_scaffold(fact),
    }


def build_gold(silver: DataFrame, path: str, one_name: bool = False) -> Gold:
    dims = build_dims(silver, path, one_name)
    fact = build_fact(silver, dims, path)
    base = materialize(m.mart_base(fact, m.deal_size(fact)), f"{path}/int_mart_base")
    return Gold(dims, fact, mart_plans(fact, dims, base), base)


FOREIGN_KEYS = {
    "agency_sk": "dim_agencies",
    "fund_sk": "dim_funds",
    "department_sk": "dim_departments",
    "account_sk": "dim_accounts",
}


def key_summary(fact: DataFrame) -> DataFrame:
    """Rows and signed totals per year, period and foreign keys: one scan for many tests."""
    amount = F.col("amount")
    return fact.groupBy("fiscal_year", "accounting_period", *FOREIGN_KEYS).agg(
        (F.sum("rows") if "rows" in fact.columns else F.count(F.lit(1))).alias("rows"),
        money_sum(F.when(amount >= 0, amount)).alias("positive"),
        money_sum(F.when(amount < 0, amount)).alias("negative"),
    )


def model_tests(
    silver: DataFrame,
    gold: Gold,
    targets: DataFrame | None = None,
    summary: DataFrame | None = None,
    known: list[Expectation] | None = None,
) -> dict[str, DataFrame]:
    """Violations of the model rules, by test name; an empty table is a pass.

    Column tests give failed expectations, the others the rows or keys at fault. The keys,
    the calendar and the totals are tested on ``summary``, which ``run_pipeline`` writes.
    ``known`` expectations have been met already and are not run again.
    """
    dims, fact = gold.dims, gold.fact
    summary = key_summary(fact) if summary is None else summary
    quarter = file_fiscal_quarter(F.col("source_path"))
    columns = [e for e in SILVER_COLUMN_SUITE if e not in (known or [])]
    suites = {
        "stg_ledger": (silver.withColumn("file_fiscal_quarter", quarter), columns),
        "fct_transactions": (fact, FACT_SUITE),
        "mart_fund_year_period": (gold.marts["mart_fund_year_period"], FUND_MART_SUITE),
        "mart_agency_fund_year": (gold.marts["mart_agency_fund_year"], AGENCY_MART_SUITE),
    }
    tests = {f"columns_{name}": failures(run_suite(*args)) for name, args in suites.items()}
    tests |= {
        "allowed_account_for_fund": allowed_pairs(silver, "fund_code", "account", ALLOWED_ACCOUNTS),
        "allowed_account_name_for_fund": allowed_pairs(
            fact, "fund_sk", "account_name", ALLOWED_ACCOUNT_NAMES
        ),
        "period_completeness": m.missing_period_rows(summary),
    }
    for sk, dim in FOREIGN_KEYS.items():
        counts = summary.groupBy(sk).agg(F.sum("rows").alias("rows")).dropna(subset=[sk])
        orphans = orphan_rows(counts, sk, dims[dim], sk)
        tests[f"relationships_{sk}"] = orphans.select(F.col(sk).alias("orphan_key"), "rows")
    if targets is not None:
        signed = F.explode(F.array("positive", "negative")).alias("amount")
        totals = summary.select("fiscal_year", signed).dropna(subset=["amount"])
        tests["reconciliation"] = reconcile(totals, targets)
    return tests


TEST_RESULT = "test string, severity string, violations bigint"
#: Tests that are reported without stopping the run.
WARN_ONLY = ("period_completeness", "reconciliation")


def run_tests(
    tests: dict[str, DataFrame], path: str, warn_only: tuple[str, ...] = WARN_ONLY
) -> DataFrame:
    """Count the violations of all tests, save (test, severity, violations) as JSON, and stop on errors."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("test"),
            F.lit("warn" if name in warn_only else "error").alias("severity"),
            "violations",
        )
        for name, df in tests.items()
    ]
    reduce(DataFrame.unionByName, counts).coalesce(1).write.mode("overwrite").json(path)
    results = next(iter(tests.values())).sparkSession.read.schema(TEST_RESULT).json(path)
    failed = results.where("severity = 'error' and violations > 0").collect()
    if failed:
        raise TestsFailed("; ".join(f"{r.test}: {r.violations} violations" for r in failed))
    return results


class TestsFailed(RuntimeError):
    """Model tests of severity ``error`` found violations."""

    __test__ = False  # not for pytest


def checked(df: DataFrame, suite: list[Expectation], name: str, path: str) -> DataFrame:
    """Run a suite once, save its results as JSON, and stop on failures."""
    results = write_results(run_suite(df, suite), path)
    gate(results, name)
    return results


def run_pipeline(
    spark: SparkSession,
    raw_root: str,
    out: str,
    pattern: str = "ledger_fy*.csv",
    silver_suite: list[Expectation] | None = None,
    gold_suite: list[Expectation] | None = None,
    targets: DataFrame | None = None,
    rebalance: bool = True,
    dedupe: bool = False,
    one_name: bool = False,
    write_joined: bool = False,
    warn_only: tuple[str, ...] = WARN_ONLY,
    csv_options: dict[str, object] | None = None,
    **staging_options: bool,
) -> tuple[Gold, dict[str, DataFrame]]:
    """Raw CSV to ``out/{silver,gold,validation}``, every table as zstd Parquet.

    Gold is built only after the silver suite holds, and the marts are written only
    after the gold suite holds. Lines that do not fit their file go to ``validation/rejects``. At the end all model tests run; their counts are saved in
    ``validation/models``, codes with several names in ``validation/names``, and a violation
    stops the run unless its test is in ``warn_only``. Each table is written once, where it is
    exported; the joined transactions stay a plan unless ``write_joined``. Returns gold and the
    violations of the model tests.
    """
    files = ledger_files(spark, raw_root, RAW_COLUMNS, pattern, **(csv_options or {}))
    write_table(files.rejects(), f"{out}/validation/rejects")
    raw = declared_columns(files.rows(), RAW_COLUMNS)
    silver = build_silver(raw, f"{out}/silver/stg_ledger", rebalance, dedupe, **staging_options)
    silver_suite = SILVER_SUITE if silver_suite is None else silver_suite
    if silver_suite:
        checked(silver, silver_suite, "silver", f"{out}/validation/silver")
    gold = build_gold(silver, f"{out}/gold", one_name)

    def write(name: str) -> DataFrame:
        gold.marts[name] = materialize(gold.marts[name], f"{out}/gold/{name}")
        return gold.marts[name]

    kpi = write("kpi_monthly_summary")
    gold_suite = GOLD_SUITE if gold_suite is None else gold_suite
    if gold_suite:
        checked(kpi, gold_suite, "gold", f"{out}/validation/gold")
    # The deltas read the written monthly totals instead of the fact once more.
    monthly = write("int_department_spend_monthly")
    gold.marts["int_variance_features"] = m.variance_vs_prior_month(monthly)
    done = {"kpi_monthly_summary", "int_department_spend_monthly"}
    if not write_joined:
        done.add("int_transactions_joined_to_dims")
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        list(pool.map(write, [name for name in gold.marts if name not in done]))
    summary = materialize(key_summary(gold.base), f"{out}/validation/key_summary")
    d.codes_with_several_names(gold.dims).write.mode("overwrite").json(f"{out}/validation/names")
    tests = model_tests(silver, gold, targets, summary, silver_suite)
    run_tests(tests, f"{out}/validation/models", warn_only)
    return gold, tests
