"""Per-column statistics of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).cast("long").alias("column_count")
    )


def table_profile(df: DataFrame, exact: bool = False, rsd: float = 0.05) -> DataFrame:
    """(column_name, row_count, null_count, distinct_count, min, max, mean, stddev).

    One pass over the table. Distinct counts are approximate within ``rsd`` unless
    ``exact``, which adds a shuffle of every column's distinct values. Mean and
    standard deviation are NULL for columns that are not numeric.
    """
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    nothing = F.lit(None)
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        aggs += [
            F.count(c).alias(f"present{i}"),
            F.min(c).cast("string").alias(f"min{i}"),
            F.max(c).cast("string").alias(f"max{i}"),
        ]
        mean = stddev = nothing.cast("double")
        if isinstance(f.dataType, T.NumericType):
            number = c.cast("double")
            aggs += [F.avg(number).alias(f"mean{i}"), F.stddev(number).alias(f"stddev{i}")]
            mean, stddev = F.col(f"mean{i}"), F.col(f"stddev{i}")
        distinct = nothing.cast("long")
        if not exact:
            aggs.append(F.approx_count_distinct(c, rsd).alias(f"distinct{i}"))
            distinct = F.col(f"distinct{i}")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col("n").alias("row_count"),
                (F.col("n") - F.col(f"present{i}")).alias("null_count"),
                distinct.alias("distinct_count"),
                F.col(f"min{i}").alias("min"),
                F.col(f"max{i}").alias("max"),
                mean.alias("mean"),
                stddev.alias("stddev"),
            )
        )
    profile = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if not exact:
        return profile
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    distinct = (
        texts.unpivot([], df.columns, "column_name", "value")
        .distinct()
        .groupBy("column_name")
        .agg(F.count("value").alias("exact_count"))
    )
    return profile.join(distinct, "column_name", "left").select(
        *[
            F.coalesce("exact_count", F.lit(0)).alias(c) if c == "distinct_count" else c
            for c in profile.columns
        ]
    )


QUANTILES = {"q05": 0.05, "q25": 0.25, "median": 0.5, "q75": 0.75, "q95": 0.95}
#: Frequent values kept by a sketch, and shown.
TRACKED, SHOWN = 200, 5


def _kind(field: T.StructField) -> str:
    if isinstance(field.dataType, T.NumericType):
        return "number"
    return "text" if isinstance(field.dataType, T.StringType) else "other"


def profile_sketches(df: DataFrame, by: list[str]) -> DataFrame:
    """One row of counts and sketches per group of ``by``, in one pass that shuffles nothing else.

    Rows of several tables, days or runs can be stored, unioned and merged by ``merge_profiles``,
    so a table that grows by partitions is profiled by its new ones. Per column: values, extremes,
    distinct values (HyperLogLog), and for numbers zeros, sums and quantiles (KLL), for texts lengths
    and frequent values. Not-a-number counts as a value and is in no sum or quantile.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(c for c in df.schema.fields if c.name not in by):
        c, kind = F.col(f.name), _kind(f)
        aggs += [F.count(c).alias(f"present{i}"), F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}")]
        hashed = F.when(c.isNotNull(), F.xxhash64(c))  # the sketch itself passes by empty texts
        aggs.append(F.hll_sketch_agg(hashed).alias(f"distinct{i}"))
        if kind == "number":
            x = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
            aggs += [F.count_if(c == 0).alias(f"zeros{i}"), F.count(x).alias(f"n{i}")]
            aggs += [F.sum(x).alias(f"sum{i}"), F.sum(x * x).alias(f"squares{i}")]
            aggs.append(F.kll_sketch_agg_double(x).alias(f"kll{i}"))
        if kind == "text":
            size = F.length(c)
            aggs += [F.min(size).alias(f"short{i}"), F.max(size).alias(f"long{i}"), F.sum(size).alias(f"chars{i}")]
            aggs.append(F.expr(f"approx_top_k_accumulate(`{f.name}`, {TRACKED})").alias(f"top{i}"))
    return df.groupBy(*by).agg(*aggs)


def merge_profiles(sketches: DataFrame, columns: list[T.StructField]) -> DataFrame:
    """The profile of all rows that ``sketches`` stand for; ``columns`` are the fields profiled, in order.

    Returns column_name, row_count, null_count, distinct_estimate, min, max, zeros, mean, stddev, the
    quantiles q05 to q95, shortest, longest, mean_length and frequent (values with estimated counts).
    The number of groups should be that of partitions, as their sketches meet in one task. No sketches
    give no rows.
    """
    nothing = F.lit(None)
    aggs, rows = [F.sum("rows").alias("rows")], []
    for i, f in enumerate(columns):
        kind = _kind(f)
        aggs += [F.sum(f"present{i}").alias(f"present{i}"), F.min(f"min{i}").cast("string").alias(f"min{i}")]
        aggs += [F.max(f"max{i}").cast("string").alias(f"max{i}")]
        aggs.append(F.hll_sketch_estimate(F.hll_union_agg(f"distinct{i}")).alias(f"distinct{i}"))
        extra = {name: nothing.cast("long") for name in ("zeros", "shortest", "longest")}
        extra |= {name: nothing.cast("double") for name in ("mean", "stddev", *QUANTILES, "mean_length")}
        extra["frequent"] = nothing.cast("array<struct<item:string,count:bigint>>")
        if kind == "number":
            aggs += [F.sum(f"{x}{i}").alias(f"{x}{i}") for x in ("zeros", "n", "sum", "squares")]
            found = F.collect_list(F.when(F.col(f"n{i}") > 0, F.col(f"kll{i}")))
            merged = F.reduce(F.slice(found, F.lit(2), F.size(found)), F.get(found, F.lit(0)), F.kll_sketch_merge_double)
            aggs.append(merged.alias(f"kll{i}"))
            n, total, squares = (F.col(f"{x}{i}") for x in ("n", "sum", "squares"))
            spread = F.greatest(squares - total * total / n, F.lit(0.0))
            extra |= {"zeros": F.col(f"zeros{i}"), "mean": F.try_divide(total, n)}
            extra["stddev"] = F.when(n > 1, F.sqrt(spread / (n - 1)))
            for name, q in QUANTILES.items():
                extra[name] = F.kll_sketch_get_quantile_double(F.col(f"kll{i}"), F.lit(q))
        if kind == "text":
            aggs += [F.min(f"short{i}").alias(f"short{i}"), F.max(f"long{i}").alias(f"long{i}")]
            aggs.append(F.sum(f"chars{i}").alias(f"chars{i}"))
            top = F.expr(f"approx_top_k_estimate(approx_top_k_combine(top{i}, {TRACKED}), {SHOWN})")
            aggs.append(top.alias(f"top{i}"))
            extra |= {"shortest": F.col(f"short{i}").cast("long"), "longest": F.col(f"long{i}").cast("long")}
            extra["mean_length"] = F.try_divide(F.col(f"chars{i}"), F.col(f"present{i}"))
            extra["frequent"] = F.col(f"top{i}").cast("array<struct<item:string,count:bigint>>")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col("rows").alias("row_count"),
                (F.col("rows") - F.col(f"present{i}")).alias("null_count"),
                F.col(f"distinct{i}").alias("distinct_estimate"),
                F.col(f"min{i}").alias("min"),
                F.col(f"max{i}").alias("max"),
                *[value.alias(name) for name, value in extra.items()],
            )
        )
    merged = sketches.groupBy(F.lit(1).alias("all")).agg(*aggs)
    return merged.select(F.inline(F.array(*rows)))
