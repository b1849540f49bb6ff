"""Text cleaning and casts for raw ledger columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The space separators of Unicode (category Zs), any other character, and
# the characters that no plain number contains.
UNICODE_SPACES = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
NOT_A_SPACE = r"\P{Zs}"
NOT_IN_NUMBERS = r"[^0-9+\-.eE\s\p{Zs}]"


def trim_text(c: Column, unicode_trim: bool = True) -> Column:
    """Strip surrounding spaces, U+00A0 and its like included; tabs stay.

    ``unicode_trim=False`` strips U+0020 only, which costs less.
    """
    return F.trim(c, F.lit(UNICODE_SPACES)) if unicode_trim else F.trim(c)


def is_ascii(*cols: str) -> Column:
    """Whether all values of a row are ASCII, so that U+0020 is the only space to trim.

    Trimming a set of characters is many times slower than trimming U+0020, so a row with many
    texts pays for the set only if it could matter.
    """
    row = F.concat_ws("", *cols)
    return F.octet_length(row) == F.length(row)


def has_text(c: Column, unicode_trim: bool = True) -> Column:
    """True when trimming leaves something, NULL for NULL."""
    return c.rlike(NOT_A_SPACE) if unicode_trim else F.trim(c) != ""


def blank_to_null(c: Column, trim: bool = True, unicode_trim: bool = True) -> Column:
    """Empty text as NULL, trimmed first unless ``trim=False``."""
    return F.nullif(trim_text(c, unicode_trim) if trim else c, F.lit(""))


def coalesce_trimmed(*cols: Column, unicode_trim: bool = True) -> Column:
    """First non-NULL trimmed value; a whitespace-only value counts and yields ``''``."""
    return F.coalesce(*[trim_text(c, unicode_trim) for c in cols])


def coalesce_nonblank(*cols: Column, unicode_trim: bool = True) -> Column:
    """First value that is neither NULL nor blank."""
    return F.coalesce(*[blank_to_null(c, unicode_trim=unicode_trim) for c in cols])


def safe_int(c: Column, unicode_trim: bool = True) -> Column:
    """Text as int by way of double, rounding halves to even; NULL when not a number.

    Surrounding spaces do not matter. The pattern keeps out texts such as ``5d`` and
    ``0x1p3`` that Spark reads as doubles.
    """
    text = number = c.cast("string")
    if unicode_trim:
        # The cast itself strips ASCII spaces; one inside a number fails either way.
        wide = UNICODE_SPACES[1:]
        number = F.translate(text, wide, " " * len(wide))
    return F.when(~text.rlike(NOT_IN_NUMBERS), F.rint(number.try_cast("double")).try_cast("int"))


def money(c: Column, clean_currency: bool = False, precision: int = 18, scale: int = 2) -> Column:
    """Text as decimal; bad text fails the job rather than becoming NULL.

    ``clean_currency`` drops dollar signs and thousands commas first.
    """
    text = F.translate(c, "$,", "") if clean_currency else c
    return text.cast(f"decimal({precision},{scale})")


def all_present(cols: list[str]) -> Column:
    """True when every column is non-NULL."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
