"""Lookups of ledger rows in dimension tables.

No join here carries a broadcast hint. A dimension that was written as a table
has a known size: Spark broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``
and otherwise shuffles both sides, where adaptive execution splits the partition
of a hot key. Nothing is broadcast on trust.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from ledgerspark.operators.aggregates import MONEY_SUM, money_sum

#: Stand between the values of a packed text, and before the letter that stands for either or for NULL.
SEPARATOR, ESCAPE = "\u001f", "\u001e"


@dataclass(frozen=True)
class Lookup:
    """Fetch ``take`` from ``table`` where ``fact_key`` equals ``dim_key``."""

    table: DataFrame
    fact_key: str
    dim_key: str
    take: list[str] = field(default_factory=list)


def _attach(df: DataFrame, lookup: Lookup, how: str) -> DataFrame:
    right = lookup.table.select(F.col(lookup.dim_key).alias("__key"), *lookup.take)
    joined = df.join(right, df[lookup.fact_key] == right["__key"], how)
    return joined.drop("__key")


def pack(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """The columns as one text ``name``, which ``unpack`` takes apart again, for rows on their way to a join.

    For few-valued texts, whole numbers and dates: a shuffle writes eight bytes and more for each
    column of a row, and compresses a text whose parts recur together better than its parts.
    """

    def part(c: str) -> Column:
        text = F.replace(F.col(c).cast("string"), F.lit(ESCAPE), F.lit(ESCAPE + "e"))
        return F.coalesce(F.replace(text, F.lit(SEPARATOR), F.lit(ESCAPE + "s")), F.lit(ESCAPE + "n"))

    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.concat_ws(SEPARATOR, *map(part, columns)).alias(name))


def unpack(df: DataFrame, name: str, fields: list[StructField]) -> DataFrame:
    """The columns that ``pack`` made the text ``name`` of; ``fields`` are theirs, in that order."""

    def part(i: int) -> Column:
        return F.substring_index(F.substring_index(name, SEPARATOR, i + 1), SEPARATOR, -1)

    def value(c: str) -> Column:
        text = F.replace(F.col(c), F.lit(ESCAPE + "s"), F.lit(SEPARATOR))
        text = F.replace(text, F.lit(ESCAPE + "e"), F.lit(ESCAPE))
        plain = ~F.contains(F.col(c), F.lit(ESCAPE))
        return F.when(plain, F.col(c)).when(F.col(c) != ESCAPE + "n", text)

    others = [c for c in df.columns if c != name]
    parts = df.select(*others, *[part(i).alias(f.name) for i, f in enumerate(fields)])
    return parts.select(*others, *[value(f.name).cast(f.dataType).alias(f.name) for f in fields])


def star_join(
    df: DataFrame, lookups: list[Lookup], columns: list[str], how: str = "left"
) -> DataFrame:
    """Join every lookup in turn and select ``columns``.

    With ``how="left"`` unmatched rows stay, with NULLs. A key with several rows in
    a lookup repeats the row once per lookup row.
    """
    return reduce(lambda d, lk: _attach(d, lk, how), lookups, df).select(*columns)


def decorate(df: DataFrame, lookups: list[Lookup], columns: list[str]) -> DataFrame:
    """Left-join names by surrogate key; the lookup columns must be new to ``df``."""
    return star_join(df, lookups, columns, "left")


def repeated_keys(lookup: Lookup) -> DataFrame:
    """(key, n) for keys that have several rows in a lookup."""
    keyed = lookup.table.dropna(subset=[lookup.dim_key]).groupBy(F.col(lookup.dim_key).alias("key"))
    return keyed.agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def weighted_sum(
    df: DataFrame, lookups: list[Lookup], by: list[str], amount: str, name: str
) -> DataFrame:
    """Sum per group as if every lookup had been left-joined, without repeating rows.

    A key with n lookup rows would repeat its rows n times, so the amount is
    multiplied by n instead. Keys that are not in ``by`` become their weight before rows are
    summed, so one row per group and weight is shuffled and not one per combination of keys; keys
    in ``by`` are weighed on the sums. Nothing runs while the plan is made.
    """

    def weighed(df: DataFrame, lookups: list[Lookup]) -> tuple[DataFrame, Column]:
        weight = F.lit(1).cast("long")
        for i, lookup in enumerate(lookups):
            many = repeated_keys(lookup).withColumnRenamed("n", f"__n{i}")
            df = _attach(df, Lookup(many, lookup.fact_key, "key", [f"__n{i}"]), "left")
            weight = weight * F.coalesce(F.col(f"__n{i}"), F.lit(1).cast("long"))
        return df, weight

    rows, weight = weighed(df, [lk for lk in lookups if lk.fact_key not in by])
    sums = rows.groupBy(*by, weight.alias("__weight")).agg(money_sum(amount).alias("__sum"))
    sums, weight = weighed(sums, [lk for lk in lookups if lk.fact_key in by])
    value = (F.col("__sum") * (F.col("__weight") * weight).cast("decimal(19,0)")).cast(MONEY_SUM)
    return sums.groupBy(*by).agg(money_sum(value).alias(name))


def one_name_per_key(dim: DataFrame, key: str, name: str) -> DataFrame:
    """One row per key, keeping the row whose ``name`` sorts first."""
    others = [c for c in dim.columns if c not in (key, name)]
    return (
        dim.groupBy(key)
        .agg(F.min(name).alias(name), *[F.min_by(c, name).alias(c) for c in others])
        .select(*dim.columns)
    )


def dedupe_on_key(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One whole row per key: the least by ``order``, then by the other columns in turn.

    So a retried task keeps the same row. Rows are reduced within tasks before the shuffle.
    """
    rest = [c for c in df.columns if c != key and c not in (order or ())]
    least = F.min(F.struct(*(order or ()), *rest)).alias("__row")
    return df.groupBy(key).agg(least).select(key, "__row.*").select(*df.columns)


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    keys = parent.select(F.col(pk).alias("__key"))
    return child.dropna(subset=[fk]).join(keys, child[fk] == keys["__key"], "left_anti")


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """(key, rows) for every non-NULL child key without a parent row.

    Counts per key before the join, so the join sees one row per key.
    """
    counts = child.dropna(subset=[fk]).groupBy(fk).agg(F.count(F.lit(1)).alias("rows"))
    return orphan_rows(counts, fk, parent, pk).select(F.col(fk).alias("orphan_key"), "rows")
