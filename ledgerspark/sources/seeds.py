"""Published targets to reconcile against."""

from __future__ import annotations

from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

TARGET_SCHEMA = "metric_name string, fiscal_year int, expected_value_usd decimal(18,2)"

# The published totals the pipeline is checked against.
PUBLISHED_TARGETS = [
    ("total_revenue", 2024, Decimal("8500000000.50")),
    ("total_expenses", 2024, Decimal("-9200000000.75")),
]


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows written in code as a table whose size Spark knows.

    Made from Arrow they are a local relation; made from Python rows they would be an
    RDD of unknown size, which Spark joins by shuffling the other side.
    """
    fields = to_arrow_schema(T.StructType.fromDDL(schema))
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, fields, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields))


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """Targets from a CSV file with a header."""
    return spark.read.schema(TARGET_SCHEMA).option("header", True).csv(path)


def targets_frame(
    spark: SparkSession, rows: list[tuple[str, int, Decimal]] | None = None
) -> DataFrame:
    """Targets given as rows; the published ones by default."""
    return small_table(spark, PUBLISHED_TARGETS if rows is None else rows, TARGET_SCHEMA)
