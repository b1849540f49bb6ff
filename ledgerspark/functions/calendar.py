"""Labels for accounting periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label of each accounting period; 0 holds opening balances.
PERIOD_NAMES = (
    "Opening Balance",
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
)
UNKNOWN = "Unknown"


def fiscal_quarter(period: Column) -> Column:
    """Q1..Q4 for periods 0..12 (0 belongs to Q1), otherwise Unknown."""
    quarter = F.greatest(F.ceil(period / F.lit(3)), F.lit(1)).cast("string")
    return F.when(period.between(0, 12), F.concat(F.lit("Q"), quarter)).otherwise(UNKNOWN)


def fiscal_month_name(period: Column) -> Column:
    """Name of the period, Unknown outside 0..12."""
    names = F.array(*[F.lit(n) for n in PERIOD_NAMES])
    return F.coalesce(F.when(period.between(0, 12), F.get(names, period)), F.lit(UNKNOWN))
