"""Hashed surrogate keys."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: placeholder hashed for a NULL part when NULL and '' must differ.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(
    *cols: str, null_as_empty: bool = True, safe: bool = False, present: Collection[str] = ()
) -> Column:
    """md5 over the column texts joined by ``-``.

    A NULL part hashes as ``''``, or as ``NULL_PART`` with ``null_as_empty=False``.
    Parts are not escaped, so ('a-', 'b') and ('a', '-b') share a key; ``safe=True``
    prefixes every part with its length, which separates them and changes the keys. ``present`` names
    columns that are known not to be NULL, which saves their check.
    """
    empty = F.lit("" if null_as_empty else NULL_PART)
    texts = [F.col(c).cast("string") for c in cols]
    parts = [t if c in present else F.coalesce(t, empty) for c, t in zip(cols, texts, strict=True)]
    if safe:
        parts = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.md5(F.concat_ws("-", *parts))
