"""Business rules that return the rows or groups breaking them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.aggregates import MONEY_SUM, money_sum
from ledgerspark.sources.seeds import small_table


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """(value, records) for non-NULL values found on more than one row.

    Only 64-bit fingerprints of all values are shuffled. Values whose fingerprint is met again,
    by repetition or by chance, are then counted as they are, so the result is exact; where
    all values are unique, none of them moves: the rows are let through to the join only once
    a repeated fingerprint has been found.
    """
    rows = df.dropna(subset=[column]).select(F.col(column).alias("value"))
    prints = F.xxhash64("value").alias("print")
    again = rows.groupBy(prints).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("print")
    found = again.agg(F.count(F.lit(1)).alias("n")).select(F.col("n") > 0).scalar()
    rows = rows.where(found).select("value", prints).join(again, "print", "left_semi")
    return rows.groupBy("value").agg(F.count(F.lit(1)).alias("records")).where("records > 1")


def unexpected_values(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """(value, records) for non-NULL values outside the allowed list."""
    return (
        df.where(~F.col(column).isin(allowed))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


def expression_violations(df: DataFrame, expression: str | Column) -> DataFrame:
    """Rows for which the expression is false; NULL passes."""
    cond = F.expr(expression) if isinstance(expression, str) else expression
    return df.where(~cond)


def unequal_columns(df: DataFrame, left: Column, right: Column, null_safe: bool = False) -> DataFrame:
    """Rows where two columns differ; NULLs pass unless ``null_safe``."""
    return df.where(~(left.eqNullSafe(right) if null_safe else left == right))


def allowed_pairs(
    df: DataFrame, key: str, value: str, rules: dict[str, list[str]] | DataFrame
) -> DataFrame:
    """Rows whose key has a rule and whose value is not among those the rule lists.

    Keys without a rule and NULL values pass; a rule that lists nothing allows nothing.
    Rules may be a mapping or a table with columns (key, value), where a NULL value
    allows nothing; joins instead of an OR chain keep the plan small for any number
    of rules.
    """
    if isinstance(rules, dict):
        pairs = [(k, v) for k, values in rules.items() for v in values or [None]]
        rules = small_table(df.sparkSession, pairs, "key string, value string")
    keys = rules.select(F.col("key").alias("__k"))
    pairs_df = rules.select(F.col("key").alias("__k"), F.col("value").alias("__v"))
    ruled = df.dropna(subset=[value]).join(keys, F.col(key) == F.col("__k"), "left_semi")
    match = (F.col(key) == F.col("__k")) & (F.col(value) == F.col("__v"))
    return ruled.join(pairs_df, match, "left_anti")


def reconcile(
    df: DataFrame,
    targets: DataFrame,
    year: str = "fiscal_year",
    amount: str = "amount",
    tolerance: str = "0.01",
    require_all: bool = False,
) -> DataFrame:
    """Yearly revenue and expense totals that differ from their published target.

    Both totals come from one pass. A total without a target and a target without
    data pass, unless ``require_all``. Amounts of 0 count as revenue.
    """
    a = F.col(amount)
    yearly = df.groupBy(F.col(year).alias("fiscal_year")).agg(
        money_sum(F.when(a >= 0, a)).alias("total_revenue"),
        money_sum(F.when(a < 0, a)).alias("total_expenses"),
    )
    calculated = yearly.unpivot(
        "fiscal_year", ["total_revenue", "total_expenses"], "metric_name", "calculated_value"
    ).dropna(subset=["calculated_value"])
    how = "full_outer" if require_all else "inner"
    both = calculated.join(targets, ["metric_name", "fiscal_year"], how)
    gap = F.abs(F.col("calculated_value") - F.col("expected_value_usd").cast(MONEY_SUM))
    off = gap > F.lit(tolerance).cast("decimal(18,2)")
    if require_all:
        off = off | F.col("calculated_value").isNull() | F.col("expected_value_usd").isNull()
    return both.where(off).select(
        "metric_name", "fiscal_year", "calculated_value", "expected_value_usd"
    )
