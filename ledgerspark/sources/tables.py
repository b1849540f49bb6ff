"""Parquet tables: write, re-read, export."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CONCURRENT_WRITES = 8
#: Partition values whose files a task keeps open while it writes.
OPEN_FILES = 64


@contextmanager
def open_partitions(spark: SparkSession, files: int = OPEN_FILES) -> Iterator[None]:
    """Writes by partition keep a file open per value that a task meets.

    Otherwise Spark sorts the whole rows of a task by partition first, which spills once they are
    more than its memory. It still does so in a task that meets more than ``files`` values.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, files)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | list[str] | None = None,
    rebalance: bool = False,
    append: bool = False,
) -> None:
    """Overwrite ``path``, or ``append`` to it, with zstd Parquet.

    ``rebalance`` gathers each partition value before writing. Without it every
    task opens a file per value it meets, which is right when the input files
    already hold one value each. Adaptive execution splits a value that is too
    large for one task and joins small ones, so a hot value is no bottleneck.
    """
    columns = [partition_by] if isinstance(partition_by, str) else partition_by
    if columns and rebalance:
        df = df.hint("rebalance", *columns)
    writer = df.write.mode("append" if append else "overwrite").option("compression", "zstd")
    if not columns:
        writer.parquet(path)
        return
    with open_partitions(df.sparkSession):
        writer.partitionBy(*columns).parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """Read a table; ``like`` gives schema and column order and saves inference."""
    if like is None:
        return spark.read.parquet(path)
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def materialize(
    df: DataFrame, path: str, partition_by: str | None = None, rebalance: bool = False
) -> DataFrame:
    """Write and re-read, so that consumers share one computation.

    The re-read table has a known size, which is what lets Spark broadcast it
    below ``spark.sql.autoBroadcastJoinThreshold`` and shuffle it above.
    """
    write_table(df, path, partition_by, rebalance)
    return read_table(df.sparkSession, path, df)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make the tables known to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def export_all(tables: dict[str, DataFrame], out: str) -> dict[str, str]:
    """Write every table to ``out/<name>``, several at a time; returns the paths."""
    paths = {name: f"{out.rstrip('/')}/{name}" for name in tables}
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        list(pool.map(lambda name: write_table(tables[name], paths[name]), tables))
    return paths
