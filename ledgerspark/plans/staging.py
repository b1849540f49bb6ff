"""Raw text columns to the typed silver ledger."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions import money, safe_int, surrogate_key
from ledgerspark.functions.cleaning import all_present, has_text, is_ascii, trim_text

# Raw column and the silver column that it becomes, in silver order.
SILVER_NAMES = {
    "AGENCYNBR": "agency_nbr",
    "AGENCYNAME": "agency_name",
    "LEDGER": "ledger",
    "FISCAL_YEAR": "fiscal_year",
    "ACCOUNTING_PERIOD": "accounting_period",
    "FUND_CODE": "fund_code",
    "FUNDDESCR": "fund_descr",
    "CLASS_FLD": "class_fld",
    "CLASSDESCR": "class_descr",
    "DEPTID": "dept_id",
    "DEPTDESCR": "dept_descr",
    "ACCOUNT": "account",
    "ACCTDESCR": "acct_descr",
    "OPERATING_UNIT": "operating_unit",
    "OPERUNITDESCR": "oper_unit_descr",
    "PRODUCT": "product",
    "PRODUCTDESCR": "product_descr",
    "PROGRAM_CODE": "program_code",
    "PGMDESCR": "pgm_descr",
    "BUDGET_REF": "budget_ref",
    "CHARTFIELD1": "chartfield1",
    "CF1DESCR": "cf1_descr",
    "CHARTFIELD2": "chartfield2",
    "CF2DESCR": "cf2_descr",
    "PROJECT_ID": "project_id",
    "PROJDESCR": "proj_descr",
    "POSTED_TOTAL_AMT": "amount",
    "ACTIVITY": "activity",
    "ACTVDESCR": "actv_descr",
    "RESTYPE": "res_type",
    "RESDESCR": "res_descr",
    "RCAT": "rcat",
    "RCATDESCR": "rcat_descr",
    "RSUBCAT": "rsubcat",
    "RSUBCATDESCR": "rsubcat_descr",
    "ROWID": "row_id",
}
RAW_COLUMNS = list(SILVER_NAMES)

# Raw columns that keep surrounding spaces, and those that become numbers.
UNTRIMMED = ["FUND_CODE", "ACCOUNT"]
NUMBERS = ["FISCAL_YEAR", "ACCOUNTING_PERIOD", "POSTED_TOTAL_AMT"]

# Columns a silver row must have, and those that make up its key.
REQUIRED = [
    "agency_nbr",
    "ledger",
    "fiscal_year",
    "accounting_period",
    "fund_code",
    "dept_id",
    "account",
    "row_id",
]
KEY_PARTS = REQUIRED[:-1] + ["project_id", "row_id", "source_path"]


def quality_filter(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Rows in which every required column is present.

    Separate conditions rather than ``dropna``, whose single expression Spark can
    only evaluate as a whole: these move to the scans one by one.
    """
    return df.where(all_present(required or REQUIRED))


def file_fiscal_quarter(source_path: Column) -> Column:
    """Quarter 1..4 named by the source file, NULL when it names none."""
    return F.regexp_extract(source_path, r"_qtr([1-4])", 1).try_cast("int")


def is_complete(unicode_trim: bool = True, nonblank_fallback: bool = False) -> Column:
    """Whether a raw line has all the columns that a silver row must have.

    Says the same of the raw texts as ``quality_filter`` of the cleaned columns, and
    costs less: Spark would evaluate the cleaning once to filter and once to select.
    """

    def text(c: Column) -> Column:
        return has_text(c, unicode_trim)

    agency, unit = F.col("AGENCYNBR"), F.col("OPERATING_UNIT")
    either = F.coalesce(text(agency), F.lit(False)) | text(unit)
    numbers = [F.col("FISCAL_YEAR"), F.col("ACCOUNTING_PERIOD")]
    conditions = [
        either if nonblank_fallback else text(F.coalesce(agency, unit)),
        *[text(F.col(c)) for c in ("LEDGER", "DEPTID", "ROWID")],
        *[F.col(c) != "" for c in UNTRIMMED],
        *[safe_int(c, unicode_trim).isNotNull() for c in numbers],
    ]
    return reduce(lambda a, b: a & b, conditions)


def stage_ledger(
    raw: DataFrame,
    with_file_quarter: bool = False,
    unicode_trim: bool = True,
    clean_currency: bool = False,
    nonblank_fallback: bool = False,
) -> DataFrame:
    """Silver ledger: one row per complete source line, ``ledger_sk`` first.

    Texts are trimmed, except fund and account, and codes that are blank then make a
    line incomplete. By default a whitespace-only AGENCYNBR blocks the fallback to
    OPERATING_UNIT; ``nonblank_fallback`` lets it through. Lines are not
    de-duplicated; see ``dedupe_on_key``.
    """
    lines = raw.where(is_complete(unicode_trim, nonblank_fallback))
    # Spark makes one method of all this, which Java compiles up to 8,000 bytes; see tests/test_speed.py.
    trimmed = [c for c in RAW_COLUMNS if c not in (*UNTRIMMED, *NUMBERS)]
    lines = lines.withColumn("__plain", is_ascii(*trimmed) if unicode_trim else F.lit(True))

    def trim(c: Column) -> Column:
        if not unicode_trim:
            return F.trim(c)
        return F.when(F.col("__plain"), F.trim(c)).otherwise(trim_text(c))

    def first(name: str, fallback: str) -> Column:
        c = F.col(name)
        if nonblank_fallback:
            c = F.when(has_text(c, unicode_trim), c)
        return trim(F.coalesce(c, fallback))

    values = {c: F.col(c) for c in UNTRIMMED} | {
        "AGENCYNBR": first("AGENCYNBR", "OPERATING_UNIT"),
        "AGENCYNAME": first("AGENCYNAME", "OPERUNITDESCR"),
        "FISCAL_YEAR": safe_int(F.col("FISCAL_YEAR"), unicode_trim),
        "ACCOUNTING_PERIOD": safe_int(F.col("ACCOUNTING_PERIOD"), unicode_trim),
        "POSTED_TOTAL_AMT": money(F.col("POSTED_TOTAL_AMT"), clean_currency),
    }
    typed = lines.select(
        *[
            values.get(raw_name, trim(F.col(raw_name))).alias(n)
            for raw_name, n in SILVER_NAMES.items()
        ],
        "source_path",
    )
    silver = typed.select(surrogate_key(*KEY_PARTS, present=REQUIRED).alias("ledger_sk"), "*")
    if with_file_quarter:
        silver = silver.withColumn("file_fiscal_quarter", file_fiscal_quarter(F.col("source_path")))
    return silver
