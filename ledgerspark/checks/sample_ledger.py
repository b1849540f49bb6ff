"""A raw ledger derived from the TPC-H-like test tables, and the layers built on it.

Every order line becomes one ledger line: nations are agencies, market segments are
funds, suppliers are departments and brands are accounts. The text is as untidy as
real extracts: padded codes, years written as ``1998.0``, agencies that are only
named in the operating unit, an agency with two names, lines that lack a required column,
periods 0 and 13, and funds without a name.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.joins import pack, unpack
from ledgerspark.operators.quality import NOT_NULL, UNIQUE, Expectation
from ledgerspark.plans.marts import kpi_monthly_summary
from ledgerspark.plans.pipeline import WARN_ONLY, build_dims, build_fact, build_silver
from ledgerspark.plans.releases import run_release
from ledgerspark.plans.staging import RAW_COLUMNS
from ledgerspark.session import fresh_path
from ledgerspark.sources.csv_files import read_ledger_csv, write_csv
from ledgerspark.sources.tables import materialize

#: By remainder of the order number modulo ODD: column and the odd text that takes its place.
ODD = 101
ODD_VALUES = {
    1: ("AGENCYNBR", None),
    2: ("LEDGER", "  "),
    3: ("FISCAL_YEAR", "n/a"),
    4: ("ACCOUNTING_PERIOD", ""),
    5: ("FUND_CODE", ""),
    6: ("DEPTID", None),
    7: ("ACCOUNT", None),
    8: ("ROWID", " "),
    9: ("ACCOUNTING_PERIOD", "0"),
    10: ("ACCOUNTING_PERIOD", "13"),
    11: ("FUNDDESCR", None),
}

RAW_FILES = "file=ledger_fy*.csv"
#: Columns with few values that travel as one text.
LINE_TEXTS = ["l_linenumber", "l_returnflag", "l_linestatus"]
PART_TEXTS = ["p_name", "p_brand", "p_type", "p_size"]
KEY_RULES = [Expectation(NOT_NULL, "amount"), Expectation(UNIQUE, "ledger_sk")]
LEDGER_OF_FLAG = {"A": "ACTUALS", "N": "BUDGET"}


def text(name: str) -> Column:
    return F.col(name).cast("string")


def line_amount() -> Column:
    """Price as money, positive for open lines and negative for the others."""
    price = F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice"))
    return price.otherwise(-F.col("l_extendedprice")).cast("decimal(18,2)")


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 36 raw text columns and the file each line would come from."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    # A line moves once for each table that is too large to be broadcast, and carries what it has
    # fetched so far. So it meets suppliers first, which add one name, and orders last; dates and
    # prices travel as days and cents, and what has few values as one text a table. Join strategies
    # are left to Spark.
    parts, lines = table("part"), table("lineitem")
    amount, day = line_amount().alias("amount"), F.col("l_shipdate").cast("date").alias("l_shipdate")
    moved = lines.select("l_orderkey", "l_partkey", "l_suppkey", amount, day, *LINE_TEXTS)
    orders = (
        table("orders")
        .withColumn("o_year", F.year("o_orderdate"))
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    )
    joined = (
        pack(moved, "__line", LINE_TEXTS)
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(pack(parts, "__part", PART_TEXTS), F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    joined = unpack(joined, "__line", [lines.schema[c] for c in LINE_TEXTS])
    lines = unpack(joined, "__part", [parts.schema[c] for c in PART_TEXTS])
    year, month = F.year("l_shipdate"), F.month("l_shipdate")
    file_name = F.concat(
        F.lit("ledger_fy"),
        F.substring(year.cast("string"), 3, 2),
        F.lit("_qtr"),
        F.quarter("l_shipdate").cast("string"),
        F.lit(".csv"),
    )
    # One source file holds one quarter. Writing by file needs no shuffle: a task keeps one part
    # file open per quarter, and the readers take the parts as one file.
    lines = lines.withColumn("source_path", file_name)
    agency = F.lpad(text("n_nationkey"), 3, "0")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    old = (F.col("n_nationkey") == 3) & (F.col("l_linenumber") == 1)
    ledger = F.lit("ENCUMBRANCE")
    for flag, name in LEDGER_OF_FLAG.items():
        ledger = F.when(F.col("l_returnflag") == flag, name).otherwise(ledger)
    values = {
        "AGENCYNBR": F.when(~urgent, F.concat(F.lit(" "), agency, F.lit("  "))),
        "AGENCYNAME": F.when(~urgent, F.concat("n_name", F.when(old, " (old)").otherwise(" "))),
        "LEDGER": F.concat(ledger, F.lit(" ")),
        "FISCAL_YEAR": F.concat(year.cast("string"), F.lit(".0")),
        "ACCOUNTING_PERIOD": F.concat(F.lit(" "), month.cast("string")),
        "FUND_CODE": F.substring("c_mktsegment", 1, 3),
        "FUNDDESCR": F.concat(F.lit(" "), "c_mktsegment"),
        "CLASS_FLD": F.col("p_type"),
        "CLASSDESCR": F.concat("p_type", F.lit(" class")),
        "DEPTID": F.concat(F.lit(" "), F.lpad(text("s_suppkey"), 7, "0")),
        "DEPTDESCR": F.concat("s_name", F.lit(" ")),
        "ACCOUNT": F.substring("p_brand", 7, 100),
        "ACCTDESCR": F.col("p_brand"),
        "OPERATING_UNIT": agency,
        "OPERUNITDESCR": F.col("n_name"),
        "PRODUCT": text("p_size"),
        "PRODUCTDESCR": F.col("p_name"),
        "PROGRAM_CODE": F.nullif("p_type", F.lit("ECONOMY")),
        "PGMDESCR": F.col("p_type"),
        "BUDGET_REF": text("o_year"),
        "CHARTFIELD1": F.col("o_orderstatus"),
        "PROJECT_ID": F.substring("o_orderpriority", 1, 1),
        "PROJDESCR": F.col("o_orderpriority"),
        "POSTED_TOTAL_AMT": text("amount"),
        "ACTIVITY": F.col("l_linestatus"),
        "ROWID": F.concat_ws(
            "-", *[text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
        ),
    }
    for rest, (column, odd) in ODD_VALUES.items():
        here = F.col("l_orderkey") % ODD == rest
        for c in ("AGENCYNBR", "OPERATING_UNIT") if column == "AGENCYNBR" else (column,):
            values[c] = F.when(here, F.lit(odd)).otherwise(values[c])
    return lines.select(
        *[values.get(c, F.lit(None)).cast("string").alias(c) for c in RAW_COLUMNS],
        "source_path",
    )


def supplier_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger lines whose department code is shared by every supplier of a nation."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        text("s_nationkey").alias("dept_id"),
        F.col("s_name").alias("dept_descr"),
        F.year("l_shipdate").alias("fiscal_year"),
        line_amount().alias("amount"),
    )


class Layers:
    """Silver, dimensions, fact and KPI mart of one data folder.

    Each is computed from the whole test tables when first asked for, written to the
    shared folder, and read from there by every later query of the session.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.root = fresh_path(spark, "layers")

    @cached_property
    def raw(self) -> DataFrame:
        return raw_ledger(self.spark, self.sf_dir)

    @cached_property
    def csv_root(self) -> str:
        """Folder of raw CSV files, one folder of part files per source file."""
        path = f"{self.root}/raw"
        write_csv(self.raw.withColumnRenamed("source_path", "file"), path, ["file"], compression="gzip")
        return path

    @cached_property
    def silver(self) -> DataFrame:
        raw = read_ledger_csv(self.spark, self.csv_root, RAW_COLUMNS, RAW_FILES)
        return build_silver(raw, f"{self.root}/silver/stg_ledger", rebalance=False)

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return build_dims(self.silver, f"{self.root}/gold")

    @cached_property
    def fact(self) -> DataFrame:
        return build_fact(self.silver, self.dims, f"{self.root}/gold")

    @cached_property
    def kpi(self) -> DataFrame:
        return materialize(
            kpi_monthly_summary(self.fact, self.dims), f"{self.root}/gold/kpi_monthly_summary"
        )

    @cached_property
    def releases(self) -> str:
        """Folder with two releases of all lines; the second read only the files that had changed.

        At the time of the first, files of one year held other amounts and those of another year
        were not there.
        """
        path, out = f"{self.root}/moving", f"{self.root}/releases"
        lines = self.raw.withColumnRenamed("source_path", "file")
        changed, late = (F.startswith("file", F.lit(f"ledger_fy{y}")) for y in ("96", "98"))
        other = F.when(changed, F.concat(F.lit("9"), F.ltrim("POSTED_TOTAL_AMT", F.lit("-"))))
        amount = F.coalesce(other, "POSTED_TOTAL_AMT")
        first = lines.where(~late).withColumn("POSTED_TOTAL_AMT", amount)
        write_csv(first, path, ["file"], compression="gzip")
        loose = (*WARN_ONLY, "columns_stg_ledger")  # the sample's years are not the accepted ones
        options = {"pattern": RAW_FILES, "silver_suite": KEY_RULES, "gold_suite": [], "warn_only": loose}
        run_release(self.spark, path, out, **options)
        write_csv(lines.where(changed | late), path, ["file"], keep_others=True, compression="gzip")
        run_release(self.spark, path, out, **options)
        return out


_LAYERS: dict[tuple[str, str], Layers] = {}


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The layers of ``sf_dir`` in this application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYERS:
        _LAYERS[key] = Layers(spark, sf_dir)
    return _LAYERS[key]
