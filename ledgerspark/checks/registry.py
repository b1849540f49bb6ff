"""The registered queries; each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import functions as fn
from ledgerspark import operators as op
from ledgerspark import plans
from ledgerspark.checks.sample_ledger import (
    ODD,
    RAW_FILES,
    Layers,
    layers,
    line_amount,
    supplier_ledger,
    text,
)
from ledgerspark.operators.aggregates import money_sum
from ledgerspark.operators.profiling import QUANTILES
from ledgerspark.operators.quality import (
    EQUAL_TO,
    IN_SET,
    VALUES_BETWEEN,
    Expectation,
    write_results,
)
from ledgerspark.plans.pipeline import WARN_ONLY, Gold, mart_plans, run_tests
from ledgerspark.plans.pipeline import model_tests as pipeline_tests
from ledgerspark.plans.releases import published
from ledgerspark.plans.staging import RAW_COLUMNS, file_fiscal_quarter, quality_filter
from ledgerspark.plans.suites import (
    AGENCY_MART_SUITE,
    FACT_SUITE,
    FISCAL_YEARS,
    FUND_MART_SUITE,
    GOLD_SUITE,
    KPI_SUITE,
    LEDGER_CONTRACT,
    MONTHS,
    NET_BALANCE,
    SILVER_COLUMN_SUITE,
    SILVER_STORED_SUITE,
    SILVER_SUITE,
)
from ledgerspark.session import fresh_path
from ledgerspark.sources import manifest
from ledgerspark.sources.csv_files import merge_raw as merge_raw_files
from ledgerspark.sources.csv_files import (
    load_summary,
    look_at_csv,
    qualified_root,
    read_csv_by_name,
    read_csv_rejects,
    read_ledger_csv,
    relative_path,
    write_csv,
)
from ledgerspark.sources.seeds import targets_frame
from ledgerspark.sources.tables import export_all, materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SAMPLE_RULES = {"AUT": ["1", "2", "3"], "BUI": ["4", "5"]}
NBSP = "\u00a0"


def query(f: Query) -> Query:
    """Register under the function's own name."""
    QUERIES[f.__name__] = f
    return f


def on_layers(f: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    """Register a query that reads the written layers."""
    QUERIES[f.__name__] = lambda spark, sf_dir: f(layers(spark, sf_dir))
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Sources and sinks


@on_layers
def csv_roundtrip(x: Layers) -> DataFrame:
    return read_ledger_csv(x.spark, x.csv_root, RAW_COLUMNS, RAW_FILES)


@query
def csv_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    root = fresh_path(spark, "drift")
    clicks = events.where(F.col("event_type") == "click")
    others = events.where(F.col("event_type") != "click")
    write_csv(clicks.select("event_id", "event_type", "user_id"), f"{root}/clicks.csv")
    cents = F.col("value").cast("decimal(18,2)").alias("value")
    write_csv(others.select("event_type", cents, "event_id"), f"{root}/others.csv")
    return read_csv_by_name(spark, root)


@query
def source_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    root = f"{sf_dir}/../{sf_dir.rstrip('/').rsplit('/', 1)[-1]}"
    path = relative_path(F.col("_metadata.file_path"), qualified_root(spark, root))
    return lines.groupBy(path.alias("source_file")).agg(F.count(F.lit(1)).alias("lines"))


def write_lines(lines: DataFrame, head: str, path: str) -> None:
    """Texts as a folder of part files, each with its own first line; tasks write what they hold."""
    first = F.monotonically_increasing_id() % (1 << 33) == 0
    text_ = F.when(first, F.concat(F.lit(head), "line")).otherwise(F.col("line"))
    lines.select(text_.alias("value")).write.text(path)


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(text("o_orderkey").alias("key"), "o_orderstatus", "o_orderpriority")


ORDER_NAMES = ["o_orderkey", "o_orderstatus", "o_orderpriority"]


def dirty_order_files(spark: SparkSession, sf_dir: str) -> str:
    """All orders in five files: commas, semicolons, blank lines first, short and long lines, quoted breaks.

    The fourth has two malformed lines for each good one. In the fifth every order is a record
    of three lines, with quotes and separators inside its quoted field.
    """
    orders = order_texts(spark, sf_dir)
    root = fresh_path(spark, "dirty")
    styles = [(",", ""), (";", ""), (",", " \n\n"), (",", ""), (",", "")]
    for k, (sep, before) in enumerate(styles):
        own = orders.where(F.col("key").cast("long") % len(styles) == k)
        line = F.concat_ws(sep, "key", "o_orderstatus", "o_orderpriority")
        if k == 3:
            line = F.concat(line, F.lit("\nx"), F.lit("\na,b,c,d"))
        if k == 4:
            note = [F.lit('"'), "o_orderpriority", F.lit('\n""'), "o_orderstatus", F.lit('"", x\n"')]
            line = F.concat_ws(",", "key", "o_orderstatus", F.concat(*note))
        write_lines(own.select(line.alias("line")), before + sep.join(ORDER_NAMES) + "\n", f"{root}/orders_{k}.csv")
    return root


@query
def csv_dirty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv_by_name(spark, dirty_order_files(spark, sf_dir))


@query
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that the reader of the same files leaves out, and why."""
    return read_csv_rejects(spark, dirty_order_files(spark, sf_dir))


@query
def csv_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read and left out per file."""
    files = look_at_csv(spark, dirty_order_files(spark, sf_dir))
    return load_summary(files.rows(), files.rejects())


@query
def csv_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in six dialects: other separators and quotes, no header, repeated and empty names."""
    orders = order_texts(spark, sf_dir)
    root = fresh_path(spark, "dialects")
    key, status, priority = F.col("key"), F.col("o_orderstatus"), F.col("o_orderpriority")

    def joined(sep: str, *parts: Column) -> Column:
        return F.concat_ws(sep, *parts)

    def quoted(quote: str, *parts: Column | str) -> Column:
        return F.concat(F.lit(quote), *[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit(quote))

    names = "key{0}status{0}priority\n"
    styles = [
        (names.format("^"), joined("^", key, status, priority)),
        (names.format(";"), joined(";", quoted("'", key), quoted("'", status, ";"), quoted("'", priority))),
        ("", joined("\t", key, status, priority)),
        (names.format(","), joined(",", key, quoted('"', status, "\n,"), priority)),
        ("key|key||\n", joined("|", key, status, priority, F.lit(""))),
        (names.format("~"), joined("~", key, F.concat(status, F.lit('" '), status), priority)),
    ]
    for k, (head, line) in enumerate(styles):
        own = orders.where(key.cast("long") % len(styles) == k)
        write_lines(own.select(line.alias("line")), head, f"{root}/style_{k}.csv")
    return read_csv_by_name(spark, root)


@query
def merge_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged, _ = merge_raw_files(spark, dirty_order_files(spark, sf_dir), fresh_path(spark, "merged"))
    return merged


def document_manifests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Manifests made of all documents: texts that changed and ids that are gone."""
    docs = table(spark, sf_dir, "documents")
    base = docs.select(
        text("doc_id").alias("path"), F.length("text").cast("long").alias("length"),
        F.sha2("text", 256).alias("sha256"), (F.col("doc_id") % 7).alias("kind"),
    )
    old = F.when(F.col("kind") == 3, F.sha2("path", 256)).otherwise(F.col("sha256"))
    before = base.withColumn("sha256", old).drop("kind")
    return base.where("kind <> 5").drop("kind"), before


@query
def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.changed_files(*document_manifests(spark, sf_dir))


@query
def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.ingest_summary(manifest.file_status(*document_manifests(spark, sf_dir)))


@on_layers
def export_reread(x: Layers) -> DataFrame:
    paths = export_all({"agencies": x.dims["dim_agencies"]}, fresh_path(x.spark, "export"))
    return x.spark.read.parquet(paths["agencies"])


@on_layers
def parquet_roundtrip(x: Layers) -> DataFrame:
    return x.silver.select("ledger_sk", "fiscal_year", "accounting_period", "amount", "row_id")


@on_layers
def stage_ledger(x: Layers) -> DataFrame:
    return plans.stage_ledger(read_ledger_csv(x.spark, x.csv_root, RAW_COLUMNS, RAW_FILES))


@on_layers
def file_quarters(x: Layers) -> DataFrame:
    quarter = file_fiscal_quarter(F.col("source_path")).alias("file_fiscal_quarter")
    return x.silver.groupBy("source_path", quarter).agg(F.count(F.lit(1)).alias("lines"))


@on_layers
def release_silver(x: Layers) -> DataFrame:
    """Silver after a run over changed files only."""
    return published(x.spark, x.releases, "stg_ledger")


@on_layers
def release_fact(x: Layers) -> DataFrame:
    return published(x.spark, x.releases, "fct_transactions")


@on_layers
def release_kpi(x: Layers) -> DataFrame:
    return published(x.spark, x.releases, "kpi_monthly_summary")


@query
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and digest of one file per document, streamed by the tasks that read them."""
    docs = table(spark, sf_dir, "documents").where("text <> ''")
    root = fresh_path(spark, "texts")
    folder = (F.col("doc_id") % 64).alias("folder")
    lines = docs.select(folder, "text").repartition("folder").sortWithinPartitions("folder", "text")
    lines.write.partitionBy("folder").text(root)
    found = manifest.file_manifest(spark, f"{root}/folder=*/*.txt")
    path = F.regexp_extract("path", "folder=([0-9]+)", 1).cast("int").alias("folder")
    return found.select(path, "length", "sha256")


# Cleaning and casts


def untidy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a code that is blank, empty, absent or padded."""
    priority = F.col("o_orderpriority")
    code = (
        F.when(priority == "1-URGENT", "   ")
        .when(priority == "2-HIGH", "")
        .when(priority == "3-MEDIUM", F.lit(None))
        .otherwise(F.concat(F.lit("  "), priority, F.lit(" ")))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", code.alias("code"), F.concat("o_orderstatus", F.lit(" ")).alias("unit")
    )


@query
def clean_trim_nullif(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("code")
    hard_space = F.concat(F.lit(NBSP), code, F.lit(NBSP))
    return untidy_orders(spark, sf_dir).select(
        "o_orderkey",
        fn.trim_text(code).alias("trimmed"),
        fn.blank_to_null(code).alias("blank_as_null"),
        fn.blank_to_null(code, trim=False).alias("empty_as_null"),
        fn.blank_to_null(hard_space).alias("unicode_trimmed"),
    )


@query
def coalesce_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = [F.col("code"), F.col("unit")]
    return untidy_orders(spark, sf_dir).select(
        "o_orderkey",
        fn.coalesce_trimmed(*pair).alias("first_present"),
        fn.blank_to_null(fn.coalesce_trimmed(*pair), trim=False).alias("first_present_or_null"),
        fn.coalesce_nonblank(*pair).alias("first_nonblank"),
    )


@query
def safe_int_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    number = (
        F.when((flag == "A") & (status == "O"), F.concat(text("l_partkey"), F.lit(".5")))
        .when(flag == "A", F.concat(F.lit(" "), text("l_linenumber"), F.lit(".0 ")))
        .when((flag == "N") & (status == "O"), F.concat(text("l_suppkey"), F.lit("e1")))
        .when(flag == "N", F.concat(F.lit("-"), text("l_orderkey"), F.lit(".5")))
        .when(status == "O", F.concat(text("l_orderkey"), F.lit("99999999999")))
        .otherwise(F.concat(text("l_orderkey"), F.lit("x")))
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", number.alias("number"), fn.safe_int(number).alias("number_int")
    )


@query
def decimal_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    exact = F.concat(cents, F.lit("5"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.money(exact).alias("rounded"),
        fn.money(F.concat(F.lit(" -"), exact)).alias("rounded_negative"),
        fn.money(F.concat(F.lit("$1,"), F.lpad(cents, 12, "0")), True).alias("from_currency"),
    )


@query
def quality_filter_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    partial = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"),
    )
    return quality_filter(partial, ["status", "priority"])


QUERIES["quality_filter"] = QUERIES.pop("quality_filter_orders")


@on_layers
def surrogate_key(x: Layers) -> DataFrame:
    return x.silver.select(
        "row_id",
        "ledger_sk",
        fn.surrogate_key("program_code", "fund_code").alias("empty_null_key"),
        fn.surrogate_key("program_code", "fund_code", null_as_empty=False).alias("marked_null_key"),
        fn.surrogate_key("program_code", "fund_code", safe=True).alias("safe_key"),
    )


@query
def period_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    period = (F.col("l_quantity").cast("int") - 2).alias("period")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(period)
        .agg(F.count(F.lit(1)).alias("lines"))
        .select(
            "period",
            fn.fiscal_quarter(F.col("period")).alias("fiscal_quarter"),
            fn.fiscal_month_name(F.col("period")).alias("fiscal_month_name"),
            "lines",
        )
    )


# Dimensions and fact


@on_layers
def dim_agencies(x: Layers) -> DataFrame:
    return plans.dim_agencies(x.silver)


@on_layers
def dim_funds(x: Layers) -> DataFrame:
    return plans.dim_funds(x.silver)


@on_layers
def dim_departments(x: Layers) -> DataFrame:
    return plans.dim_departments(x.silver)


@on_layers
def dim_accounts(x: Layers) -> DataFrame:
    return plans.dim_accounts(x.silver)


@on_layers
def dim_programs(x: Layers) -> DataFrame:
    return plans.dim_programs(x.silver)


@on_layers
def dim_time(x: Layers) -> DataFrame:
    return plans.dim_time(x.silver)


@on_layers
def fct_transactions(x: Layers) -> DataFrame:
    return plans.fct_transactions(x.silver, x.dims)


@on_layers
def transactions_decorated(x: Layers) -> DataFrame:
    return plans.transactions_decorated(x.fact, x.dims)


def shared_code_departments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Ledger sums per department code, and a dimension with many names per code."""
    ledger = supplier_ledger(spark, sf_dir)
    sums = ledger.groupBy("dept_id", "fiscal_year").agg(
        F.count(F.lit(1)).alias("lines"), money_sum("amount").alias("amount")
    )
    dim = plans.dim_departments(ledger)
    return sums, materialize(dim, fresh_path(spark, "shared_codes"))


@query
def fct_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and amounts after joining names once (fact) and twice (with names)."""
    sums, dim = shared_code_departments(spark, sf_dir)
    keys = op.Lookup(dim, "dept_id", "department_business_key", ["department_sk"])
    fact = op.star_join(sums, [keys], ["department_sk", "fiscal_year", "lines", "amount"])
    by_key = fact.groupBy("department_sk", "fiscal_year").agg(
        F.sum("lines").alias("lines"), money_sum("amount").alias("amount")
    )
    names = op.Lookup(dim, "department_sk", "department_sk", ["department_name"])
    columns = ["department_sk", "department_name", "fiscal_year", "lines", "amount"]
    return op.decorate(by_key, [names], columns)


@query
def weighted_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per department key as if its names had been joined to every line."""
    sums, dim = shared_code_departments(spark, sf_dir)
    fact = sums.select(fn.surrogate_key("dept_id").alias("department_sk"), "fiscal_year", "amount")
    names = op.Lookup(dim, "department_sk", "department_sk", ["department_name"])
    by = ["department_sk", "fiscal_year"]
    return op.weighted_sum(fact, [names], by, "amount", "total_amount")


@query
def dim_one_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = plans.dim_departments(supplier_ledger(spark, sf_dir))
    return op.one_name_per_key(dim, "department_business_key", "department_name")


@query
def dedupe_on_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line of each order that ships first, whole."""
    lines = table(spark, sf_dir, "lineitem")
    return op.dedupe_on_key(lines, "l_orderkey", ["l_shipdate", "l_linenumber"])


@query
def fct_one_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums, dim = shared_code_departments(spark, sf_dir)
    one = op.one_name_per_key(dim, "department_business_key", "department_name")
    keys = op.Lookup(one, "dept_id", "department_business_key", ["department_sk", "department_name"])
    columns = ["department_sk", "department_name", "fiscal_year", "amount"]
    return op.star_join(sums, [keys], columns)


@on_layers
def relationships_violations(x: Layers) -> DataFrame:
    """All lines of one fund point to a key that no fund has."""
    other = F.md5(F.concat(F.lit("other "), "fund_sk"))
    child = F.when(F.col("fund_sk") == F.md5(F.lit("BUI")), other).otherwise(F.col("fund_sk"))
    return op.orphan_keys(x.fact.withColumn("fund_sk", child), "fund_sk", x.dims["dim_funds"], "fund_sk")


@on_layers
def relationships_violation_rows(x: Layers) -> DataFrame:
    """The lines of five agencies point to keys that no agency has."""
    columns = ["agency_sk", "department_sk", "fiscal_year", "accounting_period", "amount"]
    moved = F.col("agency_sk").isin(*[F.md5(F.lit(f"00{k}")) for k in range(5)])
    other = F.concat(F.lit("other "), "agency_sk")
    child = F.when(moved, other).otherwise(F.col("agency_sk"))
    rows = x.fact.select(*columns).withColumn("agency_sk", child)
    return op.orphan_rows(rows, "agency_sk", x.dims["dim_agencies"], "agency_sk")


# Marts


@on_layers
def kpi_monthly_summary(x: Layers) -> DataFrame:
    return plans.kpi_monthly_summary(x.fact, x.dims)


@on_layers
def mart_base(x: Layers) -> DataFrame:
    return plans.mart_base(x.fact, plans.deal_size(x.fact))


@on_layers
def marts_from_base(x: Layers) -> DataFrame:
    """Rows and net of each mart that is rolled up from the written base."""
    base = materialize(plans.mart_base(x.fact, plans.deal_size(x.fact)), fresh_path(x.spark, "base"))
    marts = mart_plans(x.fact, x.dims, base)
    names = {"kpi_monthly_summary": "net_amount", "mart_fund_year_period": "net_amount"}
    names |= {"mart_agency_fund_year": "net_amount", "int_department_spend_monthly": "total_monthly_amount"}
    names |= {"mart_budget_variance_by_fund": "budget_variance"}
    parts = [
        marts[name].agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("rows"), money_sum(net).alias("net"))
        for name, net in names.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@on_layers
def mart_fund_year_period(x: Layers) -> DataFrame:
    return plans.mart_fund_year_period(x.fact, x.dims)


@on_layers
def mart_agency_fund_year(x: Layers) -> DataFrame:
    return plans.mart_agency_fund_year(x.fact, x.dims)


@on_layers
def department_spend_monthly(x: Layers) -> DataFrame:
    return plans.department_spend_monthly(x.fact, x.dims)


@on_layers
def variance_vs_prior_month(x: Layers) -> DataFrame:
    return plans.variance_vs_prior_month(plans.department_spend_monthly(x.fact, x.dims))


@on_layers
def budget_variance(x: Layers) -> DataFrame:
    return plans.budget_variance(x.fact)


def uneven_funds(x: Layers) -> DataFrame:
    """The fact with funds that only have a budget and lines that have no fund."""
    aut, bui = F.md5(F.lit("AUT")), F.md5(F.lit("BUI"))
    planned = (F.col("fund_sk") == aut) & (F.col("ledger") == "ACTUALS")
    rows = x.fact.withColumn("ledger", F.when(planned, "BUDGET").otherwise(F.col("ledger")))
    return rows.withColumn("fund_sk", F.nullif("fund_sk", bui))


@on_layers
def budget_variance_uneven(x: Layers) -> DataFrame:
    return plans.budget_variance(uneven_funds(x))


@on_layers
def budget_variance_conformed(x: Layers) -> DataFrame:
    return plans.budget_variance_conformed(uneven_funds(x))


@on_layers
def completeness_scaffold(x: Layers) -> DataFrame:
    return plans.completeness_scaffold(x.fact)


@on_layers
def missing_periods(x: Layers) -> DataFrame:
    return plans.missing_period_rows(x.fact)


@on_layers
def missing_from_scaffold(x: Layers) -> DataFrame:
    return op.missing_from(plans.completeness_scaffold(x.fact), x.fact)


@on_layers
def revenue_by_department(x: Layers) -> DataFrame:
    return plans.revenue_by_department(x.kpi)


@on_layers
def filtered_rollup(x: Layers) -> DataFrame:
    return plans.filtered_rollup(x.fact, x.dims, fiscal_year=1998, fund_code="AUT")


@on_layers
def department_rollup(x: Layers) -> DataFrame:
    return plans.filtered_rollup(x.fact, x.dims, department="Supplier#000000001")


# Dashboard


@on_layers
def total_transactions(x: Layers) -> DataFrame:
    return op.totals(x.fact).select("total_transactions")


@on_layers
def total_amount(x: Layers) -> DataFrame:
    return op.totals(x.fact).select("total_amount")


@query
def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = money_sum(F.col("value").cast("decimal(18,2)"))
    return op.top_groups(table(spark, sf_dir, "events"), "event_type", total, "total")


@on_layers
def top_accounts(x: Layers) -> DataFrame:
    return op.top_groups(x.fact, "account_name", money_sum("amount"), "total", 10)


@query
def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = money_sum(F.col("o_totalprice").cast("decimal(18,2)"))
    return op.monthly_trend(table(spark, sf_dir, "orders"), "o_orderdate", total, "total")


# Data quality


@on_layers
def expectations_silver(x: Layers) -> DataFrame:
    return op.run_suite(x.silver, SILVER_SUITE)


@on_layers
def expectations_gold(x: Layers) -> DataFrame:
    return op.run_suite(x.kpi, GOLD_SUITE)


@on_layers
def expectation_failures(x: Layers) -> DataFrame:
    return op.failures(op.run_suite(x.silver, SILVER_SUITE))


@on_layers
def suite_statistics(x: Layers) -> DataFrame:
    return op.statistics(op.run_suite(x.kpi, GOLD_SUITE))


@on_layers
def expectations_silver_columns(x: Layers) -> DataFrame:
    quarter = file_fiscal_quarter(F.col("source_path"))
    return op.run_suite(x.silver.withColumn("file_fiscal_quarter", quarter), SILVER_COLUMN_SUITE)


@on_layers
def expectations_kpi(x: Layers) -> DataFrame:
    return op.run_suite(x.kpi, KPI_SUITE)


@on_layers
def expectations_marts(x: Layers) -> DataFrame:
    """Column tests of the fact and of the two fund marts."""
    funds = op.run_suite(plans.mart_fund_year_period(x.fact, x.dims), FUND_MART_SUITE)
    agencies = op.run_suite(plans.mart_agency_fund_year(x.fact, x.dims), AGENCY_MART_SUITE)
    return op.run_suite(x.fact, FACT_SUITE).unionByName(funds).unionByName(agencies)


@on_layers
def in_set_mostly(x: Layers) -> DataFrame:
    """Sets, bounds and an equality whose passing shares lie on both sides of the limit."""
    return op.run_suite(
        x.silver,
        [
            Expectation(IN_SET, "accounting_period", values=MONTHS, mostly=0.95),
            Expectation(IN_SET, "program_code", values=("STANDARD", "PROMO"), mostly=0.95),
            Expectation(IN_SET, "ledger", values=("ACTUALS", "BUDGET"), mostly=0.5),
            Expectation(VALUES_BETWEEN, "fiscal_year", min_value=1996, mostly=0.5),
            Expectation(EQUAL_TO, "fund_code", expression="substr(fund_descr, 1, 3)"),
        ],
    )


@query
def unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("row_id")
    return op.duplicate_values(table(spark, sf_dir, "lineitem").select(key), "row_id")


@on_layers
def accepted_values_violations(x: Layers) -> DataFrame:
    return op.unexpected_values(x.silver, "fiscal_year", list(FISCAL_YEARS))


@on_layers
def net_balance_violations(x: Layers) -> DataFrame:
    """The balance rule (holds) and months whose revenue is not their net (many)."""
    columns = ["fiscal_year", "month", "department_name"]
    broken = op.expression_violations(x.kpi, NET_BALANCE)
    unequal = op.unequal_columns(x.kpi, F.col("net_amount"), F.col("total_revenue"))
    return broken.select(F.lit("net_balance").alias("rule"), *columns).unionByName(
        unequal.select(F.lit("no_expenses").alias("rule"), *columns)
    )


@on_layers
def allowed_pairs(x: Layers) -> DataFrame:
    columns = ["ledger_sk", "fund_code", "account"]
    return op.allowed_pairs(x.silver.select(*columns), "fund_code", "account", SAMPLE_RULES)


@on_layers
def reconcile_targets(x: Layers) -> DataFrame:
    """Targets taken from the complete order lines; expenses after 1997 are off by two cents."""
    lines = table(x.spark, x.sf_dir, "lineitem").where(~(F.col("l_orderkey") % ODD).between(1, 8))
    lines = lines.select(F.year("l_shipdate").alias("fiscal_year"), line_amount().alias("amount"))
    metric = F.when(F.col("amount") >= 0, "total_revenue").otherwise("total_expenses")
    totals = lines.groupBy(metric.alias("metric_name"), "fiscal_year").agg(money_sum("amount").alias("total"))
    off = (F.col("metric_name") == "total_expenses") & (F.col("fiscal_year") > 1997)
    shift = F.when(off, F.expr("0.02BD")).otherwise(F.expr("0.01BD"))
    target = (F.col("total") + shift).cast("decimal(18,2)").alias("expected_value_usd")
    targets = totals.select("metric_name", "fiscal_year", target)
    return op.reconcile(x.silver, targets.unionByName(targets_frame(x.spark)))


@on_layers
def model_tests(x: Layers) -> DataFrame:
    """All model tests, counted and saved; the sample's years are outside the accepted ones."""
    gold = Gold(x.dims, x.fact, mart_plans(x.fact, x.dims))
    tests = pipeline_tests(x.silver, gold)
    return run_tests(tests, fresh_path(x.spark, "tests"), (*WARN_ONLY, "columns_stg_ledger"))


@on_layers
def suite_json(x: Layers) -> DataFrame:
    return write_results(op.run_suite(x.kpi, GOLD_SUITE), fresh_path(x.spark, "results"))


@on_layers
def rollup_by_ordinal(x: Layers) -> DataFrame:
    text_ = "select fiscal_year, ledger, cast(sum(amount) as decimal(38,2)) as total from {fact} group by 1, 2"
    return x.spark.sql(text_, fact=x.fact)


def contract_source(x: Layers) -> DataFrame:
    return x.silver.select(
        F.col("amount"),
        text("fiscal_year").alias("fiscal_year"),
        F.ceil(F.col("accounting_period") / 3).alias("quarter"),
        F.col("dept_descr").alias("department_name"),
        F.col("product_descr").alias("vendor_name"),
        F.col("acct_descr").alias("transaction_description"),
        F.col("fund_code"),
        F.col("row_id"),
    )


@on_layers
def schema_contract(x: Layers) -> DataFrame:
    """Every row in the contract's types, and the rules it breaks: many of the sample's years are too early."""
    return op.apply_contract(contract_source(x), LEDGER_CONTRACT, broken="broken_rules")


@on_layers
def schema_contract_violations(x: Layers) -> DataFrame:
    return op.contract_violations(contract_source(x), LEDGER_CONTRACT)


def untidy_contract_source(x: Layers) -> DataFrame:
    """The contract's columns as texts, with years, amounts and quarters that break it."""
    period, year = F.col("accounting_period"), text("fiscal_year")
    dollars = (period == 4) & (F.col("ledger") == "ENCUMBRANCE")
    return x.silver.select(
        "ledger_sk",
        F.when(dollars, F.concat(F.lit("$"), text("amount"))).otherwise(text("amount")).alias("amount"),
        F.when(period == 2, F.concat(F.lit("FY"), year)).when(period != 3, year).alias("fiscal_year"),
        F.ceil(period / 3).alias("quarter"),
        F.col("dept_descr").alias("department_name"),
        F.col("product_descr").alias("vendor_name"),
        F.col("acct_descr").alias("transaction_description"),
        "fund_code",
    )


@on_layers
def contract_failure_cases(x: Layers) -> DataFrame:
    return op.split_by_contract(untidy_contract_source(x), LEDGER_CONTRACT, "ledger_sk")[1]


@on_layers
def contract_accepted(x: Layers) -> DataFrame:
    """The rows that keep a contract whose years are those of the sample."""
    years = [replace(f, ge=1990) if f.name == "fiscal_year" else f for f in LEDGER_CONTRACT]
    return op.split_by_contract(untidy_contract_source(x), years, "ledger_sk")[0]


@on_layers
def suite_from_json(x: Layers) -> DataFrame:
    """The silver suite, written as JSON, read back and run."""
    path = fresh_path(x.spark, "suite")
    op.write_suite(x.spark, SILVER_STORED_SUITE, path, "silver_ledger_suite")
    return op.run_suite(x.silver, op.read_suite(x.spark, path))


def rounded(profile: DataFrame) -> DataFrame:
    return profile.withColumns({"mean": F.round("mean", 3), "stddev": F.round("stddev", 3)})


@on_layers
def table_profile(x: Layers) -> DataFrame:
    return rounded(op.table_profile(x.silver, exact=True))


@on_layers
def table_profile_approx(x: Layers) -> DataFrame:
    """The shuffle-free profile, and whether its distinct counts are within three deviations."""
    rsd = 0.05
    exact = op.table_profile(x.silver, exact=True).select("column_name", F.col("distinct_count").alias("exact"))
    both = rounded(op.table_profile(x.silver, rsd=rsd)).join(exact, "column_name")
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= 3 * rsd * F.col("exact")
    return both.withColumn("close", close).withColumn("distinct_count", F.col("exact")).drop("exact")


@on_layers
def profile_merged(x: Layers) -> DataFrame:
    """Sketches of every year, stored and merged, and whether quantiles lie within 2 % of their ranks."""
    columns = [f for f in x.silver.schema.fields if f.name != "fiscal_year"]
    sketches = materialize(op.profile_sketches(x.silver, ["fiscal_year"]), fresh_path(x.spark, "sketches"))
    merged = materialize(op.merge_profiles(sketches, columns), fresh_path(x.spark, "profile"))
    checks = []
    for r in merged.where("median is not null").collect():  # one row per numeric column
        c = F.col(r.column_name).cast("double")
        shares = [(p, F.avg((c < r[q]).cast("int")), F.avg((c <= r[q]).cast("int"))) for q, p in QUANTILES.items()]
        near = [(below - 0.02 <= p) & (upto + 0.02 >= p) for p, below, upto in shares]
        checks.append(F.struct(F.lit(r.column_name).alias("column_name"), F.array_min(F.array(*near)).alias("close")))
    close = x.silver.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))
    exact = ["column_name", "row_count", "null_count", "min", "max", "zeros", "shortest", "longest"]
    digits = {"mean": 2, "stddev": 1, "mean_length": 2}
    rounded_ = [F.round(c, n).alias(c) for c, n in digits.items()]
    return merged.join(close, "column_name", "left").select(
        *exact, *rounded_, F.coalesce("close", F.lit(True)).alias("quantiles_close")
    )


@on_layers
def table_shape(x: Layers) -> DataFrame:
    return op.table_shape(x.silver)
