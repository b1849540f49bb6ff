"""Grouped sums over money columns.

Every result sum is decimal(38,2). Spark aggregates within each task before it
shuffles, so a key holding a large share of the rows costs one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_SUM = "decimal(38,2)"
MEASURES = ("total_revenue", "total_expenses", "net_amount", "transaction_count")


def money_sum(c: Column | str) -> Column:
    return F.sum(c).cast(MONEY_SUM)


def signed_rollup(
    df: DataFrame, by: list[str], amount: str = "amount", inclusive_zero: bool = True,
    rows: str | None = None,
) -> DataFrame:
    """Revenue (positive part), expenses (negative part), net and row count per group.

    A NULL amount counts as 0 in revenue and expenses and is skipped by the net,
    so a group of NULLs has net NULL. ``inclusive_zero`` tests ``>= 0`` instead of
    ``> 0``; the sums are the same. ``rows`` names the number of rows that a row of sums of one
    sign stands for, as ``sums_by_sign`` gives them.
    """
    a = F.col(amount)
    zero = F.lit(0).cast("decimal(18,2)")
    positive = a >= 0 if inclusive_zero else a > 0
    return df.groupBy(*by).agg(
        money_sum(F.when(positive, a).otherwise(zero)).alias("total_revenue"),
        money_sum(F.when(a < 0, a).otherwise(zero)).alias("total_expenses"),
        money_sum(a).alias("net_amount"),
        (F.sum(rows) if rows else F.count(F.lit(1))).alias("transaction_count"),
    )


def sums_by_sign(df: DataFrame, by: list[str], amount: str = "amount") -> DataFrame:
    """Rows and sum per group and sign of the amount: ``by``, sign, amount, rows.

    Every coarser signed rollup can be taken from these. NULL amounts are groups of their own.
    """
    a = F.col(amount)
    sign = F.when(a > 0, 1).when(a < 0, -1).when(a == 0, 0).alias("sign")
    return df.groupBy(*by, sign).agg(money_sum(a).alias(amount), F.count(F.lit(1)).alias("rows"))


def regroup(df: DataFrame, by: list[str], measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Sum already rolled-up measures over a coarser grouping."""
    counts = {"transaction_count"}
    return df.groupBy(*by).agg(
        *[(F.sum(m) if m in counts else money_sum(m)).alias(m) for m in measures]
    )


def grouped_sum(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(money_sum(value).alias(name))


def totals(df: DataFrame, amount: str = "amount") -> DataFrame:
    """One row: number of rows and sum of the amounts."""
    return df.agg(
        F.count(F.lit(1)).alias("total_transactions"), money_sum(amount).alias("total_amount")
    )


def top_groups(df: DataFrame, by: str, value: Column, name: str, k: int = 10) -> DataFrame:
    """The ``k`` groups with the largest sum, ties by group name; NULLs last."""
    return (
        df.groupBy(by)
        .agg(value.alias(name))
        .orderBy(F.desc_nulls_last(name), F.asc_nulls_last(by))
        .limit(k)
    )


def monthly_trend(df: DataFrame, ts: str, value: Column, name: str) -> DataFrame:
    """Value per calendar month of a timestamp, in time order."""
    month = F.date_trunc("month", ts).cast("timestamp_ntz")
    return (
        df.groupBy(month.alias("month")).agg(value.alias(name)).orderBy(F.asc_nulls_last("month"))
    )


def plan_vs_actual(
    df: DataFrame,
    by: list[str],
    amount: str = "amount",
    ledger: str = "ledger",
    actual: str = "ACTUALS",
    plan: str = "BUDGET",
    keep_plan_keys: bool = False,
) -> DataFrame:
    """Actual and planned sums per group and their difference (plan - actual).

    Equals a full outer join of the two sums, in one pass and one shuffle. The
    keys come from the actual side, so a group with a plan only has NULL keys,
    and a group whose key is NULL on both sides never matches and gives two rows.
    ``keep_plan_keys=True`` keeps one fully keyed row per group instead.
    """
    is_actual, is_plan = F.col(ledger) == actual, F.col(ledger) == plan
    zero = F.lit(0).cast(MONEY_SUM)
    sums = (
        df.where(F.col(ledger).isin(actual, plan))
        .groupBy(*by)
        .agg(
            money_sum(F.when(is_actual, F.col(amount))).alias("a"),
            money_sum(F.when(is_plan, F.col(amount))).alias("p"),
            F.count_if(is_actual).alias("n_a"),
            F.count_if(is_plan).alias("n_p"),
        )
    )

    def row(keys: bool, a: Column, p: Column) -> Column:
        key_cols = [(F.col(k) if keys else F.lit(None)).alias(k) for k in by]
        return F.struct(
            *[k.cast(sums.schema[n].dataType).alias(n) for k, n in zip(key_cols, by, strict=True)],
            a.alias("actual_amount"),
            p.alias("budgeted_amount"),
            (p - a).cast(MONEY_SUM).alias("budget_variance"),
        )

    a, p = F.coalesce("a", zero), F.coalesce("p", zero)
    if keep_plan_keys:
        return sums.select(row(True, a, p).alias("r")).select("r.*")
    has_a, has_p = F.col("n_a") > 0, F.col("n_p") > 0
    keyed = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in by])
    rows = (
        F.when(has_a & has_p & keyed, F.array(row(True, a, p)))
        .when(has_a & has_p, F.array(row(True, a, zero), row(False, zero, p)))
        .when(has_a, F.array(row(True, a, zero)))
        .otherwise(F.array(row(False, zero, p)))
    )
    return sums.select(F.explode(rows).alias("r")).select("r.*")
