"""Period series: deltas, expected periods and the ones missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PERIODS = tuple(range(1, 13))


def prior_period_delta(
    df: DataFrame, by: list[str], order: list[str], value: str, name: str
) -> DataFrame:
    """Value minus that of the previous row present in the group.

    The first row's delta is its own value; a NULL previous value gives NULL. Pass
    rows already summed per period, so that a group is as long as its calendar.
    """
    previous = F.lag(value, 1, 0).over(Window.partitionBy(*by).orderBy(*order))
    return df.select(*by, *order, (F.col(value) - previous).cast("decimal(38,2)").alias(name))


def period_scaffold(
    df: DataFrame, keys: list[str], period: str, periods: tuple[int, ...] = PERIODS
) -> DataFrame:
    """Every distinct key combination with every expected period."""
    expected = F.array(*[F.lit(p).cast("long") for p in periods])
    return df.select(*keys).distinct().select(*keys, F.explode(expected).alias(period))


def missing_from(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Distinct expected rows absent from ``actual``; NULLs compare equal.

    Columns are matched by name and take the expected types. The actual rows are
    reduced to distinct ones before they are shuffled.
    """
    aligned = actual.select(*[F.col(f.name).cast(f.dataType) for f in expected.schema])
    return expected.subtract(aligned.distinct())


def missing_periods(
    df: DataFrame, keys: list[str], period: str, periods: tuple[int, ...] = PERIODS
) -> DataFrame:
    """Expected periods that a key combination has no row for.

    Same rows as the scaffold minus the distinct data, with one shuffle and no
    join: the expected periods seen are collected per key, as many as the calendar has.
    """
    expected = F.array(*[F.lit(n).cast("long") for n in periods])
    known = F.when(F.col(period).isin(*periods), F.col(period).cast("long"))
    seen = df.groupBy(*keys).agg(F.collect_set(known).alias("seen"))
    return seen.select(*keys, F.explode(F.array_except(expected, "seen")).alias(period))
