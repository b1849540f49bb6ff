from ledgerspark.functions.calendar import fiscal_month_name, fiscal_quarter
from ledgerspark.functions.cleaning import (
    blank_to_null,
    coalesce_nonblank,
    coalesce_trimmed,
    money,
    safe_int,
    trim_text,
)
from ledgerspark.functions.keys import surrogate_key

__all__ = [
    "blank_to_null",
    "coalesce_nonblank",
    "coalesce_trimmed",
    "fiscal_month_name",
    "fiscal_quarter",
    "money",
    "safe_int",
    "surrogate_key",
    "trim_text",
]
