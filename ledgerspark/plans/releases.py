"""Published versions of all tables, and runs over changed files only.

A run writes into a folder of its own and is published by one small commit record, which is renamed
into place after all gates have passed. Readers follow the newest record, so a run that fails, or
is still going on, changes nothing they see. A record names the folders of every table
and, for tables kept by fiscal year, the years to take from each: years without changes stay in
the folder where an earlier run has written them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.operators.quality import Expectation
from ledgerspark.plans import dims as d
from ledgerspark.plans import marts as m
from ledgerspark.plans.facts import fct_transactions
from ledgerspark.plans.pipeline import (
    FOREIGN_KEYS,
    WARN_ONLY,
    Gold,
    build_dims,
    checked,
    key_summary,
    model_tests,
    run_tests,
)
from ledgerspark.plans.staging import RAW_COLUMNS, stage_ledger
from ledgerspark.plans.suites import GOLD_SUITE, SILVER_SUITE
from ledgerspark.sources.csv_files import declared_columns, ledger_files, qualified_root, source_name
from ledgerspark.sources.manifest import changed_files, file_manifest
from ledgerspark.sources.tables import materialize, read_table, write_table

RECORDS = "_releases"
#: Code column of silver, by dimension that the fact is joined with.
CODES = {name: d.DIMENSIONS[name].key for name in FOREIGN_KEYS.values()}


@dataclass(frozen=True)
class Part:
    """A folder of a table, and the fiscal years that are read from it (None: all rows)."""

    path: str
    years: list[int] | None = None


@dataclass(frozen=True)
class Release:
    """A commit record: number, parts and schema by table, and the folder of the file manifest."""

    number: int
    tables: dict[str, list[Part]]
    schemas: dict[str, str]
    manifest: str

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schemas[table]))
        return read_parts(spark, self.tables[table], schema)


def _files(spark: SparkSession, path: str) -> tuple:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def latest(spark: SparkSession, out: str) -> Release | None:
    """The newest published release, or None."""
    fs, folder = _files(spark, f"{out}/{RECORDS}")
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    records = sorted(n for n in names if re.fullmatch(r"\d{8}\.json", n))
    if not records:
        return None
    record = json.loads("\n".join(r.value for r in spark.read.text(f"{out}/{RECORDS}/{records[-1]}").collect()))
    tables = {name: [Part(**p) for p in parts] for name, parts in record["tables"].items()}
    return Release(record["number"], tables, record["schemas"], record["manifest"])


def publish(spark: SparkSession, out: str, release: Release) -> None:
    """Make a release the newest one. Of two runs that publish one number the second fails."""
    fs, target = _files(spark, f"{out}/{RECORDS}/{release.number:08d}.json")
    _, draft = _files(spark, f"{out}/{RECORDS}/.draft-{release.number:08d}-{id(release):x}")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(asdict(release)).encode()))
    stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"release {release.number} has been published already")


def read_parts(spark: SparkSession, parts: Iterable[Part], schema: T.StructType) -> DataFrame:
    """One table from its folders; a filter on the year prunes the others' files."""
    frames = []
    for part in parts:
        df = spark.read.schema(schema).parquet(part.path).select(*schema.fieldNames())
        frames.append(df if part.years is None else df.where(F.col("fiscal_year").isin(part.years)))
    return reduce(DataFrame.unionByName, frames, spark.createDataFrame([], schema))


def published(spark: SparkSession, out: str, table: str) -> DataFrame:
    """A table of the newest release."""
    release = latest(spark, out)
    if release is None:
        raise FileNotFoundError(f"nothing published in {out}")
    return release.read(spark, table)


def with_years(old: list[Part], path: str, years: list[int]) -> list[Part]:
    """The parts of a table whose ``years`` have been written anew to ``path``."""
    rest = [Part(p.path, [y for y in p.years or [] if y not in years]) for p in old]
    return [p for p in rest if p.years] + [Part(path, years)] * bool(years)


def _years(df: DataFrame) -> set[int]:
    return {r.fiscal_year for r in df.select("fiscal_year").distinct().collect()}


BASE, SUMMARY = "int_mart_base", "key_summary"
#: Tables whose rows belong to one fiscal year each and depend on its facts only. The first group by
#: department, month and more, as the base does, and are written with it.
DEALT_MARTS = {
    SUMMARY: lambda fact, dims: key_summary(fact),
    "kpi_monthly_summary": m.kpi_monthly_summary,
    "int_department_spend_monthly": m.department_spend_monthly,
}
YEARLY_MARTS = {
    "mart_fund_year_period": m.mart_fund_year_period,
    "mart_agency_fund_year": m.mart_agency_fund_year,
    "mart_completeness_scaffold": lambda fact, dims: m.completeness_scaffold(fact),
}


def write_together(frames: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Write several tables by fiscal year in one job, in which equal shuffles run once; returns their paths."""
    tagged = [df.withColumn("mart", F.lit(name)) for name, df in frames.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    write_table(rows, path, ["mart", "fiscal_year"])
    paths = {name: f"{path}/mart={name}" for name in frames}
    for own in paths.values():  # a table without rows has none
        fs, folder = _files(rows.sparkSession, own)
        fs.mkdirs(folder)
    return paths


def run_release(
    spark: SparkSession,
    raw_root: str,
    out: str,
    pattern: str = "ledger_fy*.csv",
    silver_suite: list[Expectation] | None = None,
    gold_suite: list[Expectation] | None = None,
    targets: DataFrame | None = None,
    warn_only: tuple[str, ...] = WARN_ONLY,
    incremental: bool = True,
    csv_options: dict[str, object] | None = None,
    **staging_options: bool,
) -> Release:
    """Bring the tables up to date with the raw files, test them, and publish.

    Only files that are new, changed or gone since the last release are read. The fiscal years that
    their lines have, or had, are written anew in silver; the fact and the marts are written
    anew for these years and for those in which a code whose names have changed occurs,
    as a further name repeats its rows. Dimensions, the deltas against the prior month and the budget
    variance are small or cross years and are written whole. ``incremental=False`` reads
    everything, as does a run after a release that has no key summary. Without changes the last
    release is returned. Suites and model tests run on the whole
    tables before the release is published; a failure raises and leaves the last release as it is.
    """
    last = latest(spark, out)
    number = last.number + 1 if last else 1
    folder = f"{out}/release-{number:08d}-{spark.sparkContext.applicationId}"
    root = qualified_root(spark, raw_root)
    incremental = incremental and last is not None and SUMMARY in last.tables
    manifest = materialize(file_manifest(spark, f"{root}/{pattern}"), f"{folder}/manifest")
    before = read_table(spark, last.manifest) if incremental else manifest.limit(0)
    moved = changed_files(manifest, before).select("path")
    moved = moved.unionByName(before.join(manifest, "path", "left_anti").select("path"))
    changed = {source_name(r.path, root) for r in moved.collect()}
    if incremental and not changed:
        return last
    old = last if incremental else None
    tables: dict[str, list[Part]] = {}
    schemas: dict[str, str] = {}

    def table(name: str, schema: T.StructType, path: str, years: list[int] | None) -> DataFrame:
        """Note a written table, or the given years of it, and read all of it."""
        earlier = old.tables[name] if old and years is not None else []
        tables[name] = [Part(path)] if years is None else with_years(earlier, path, years)
        schemas[name] = schema.json()
        return read_parts(spark, tables[name], schema)

    def write(name: str, df: DataFrame, years: list[int] | None) -> DataFrame:
        path = f"{folder}/gold/{name}"
        write_table(df, path, None if years is None else "fiscal_year")
        return table(name, df.schema, path, years)

    # Silver: lines of changed files, and the other lines of the years these touch, which follow
    # into the same folder.
    current = [r.path for r in manifest.select("path").collect()]
    to_read = [p for p in current if source_name(p, root) in changed]
    moved_source = F.col("source_path").isin(sorted(changed))
    years: set[int] = set()
    silver_path, schema = f"{folder}/silver/stg_ledger", None
    if to_read:
        files = ledger_files(spark, raw_root, RAW_COLUMNS, pattern, paths=to_read, **(csv_options or {}))
        staged = stage_ledger(declared_columns(files.rows(), RAW_COLUMNS), **staging_options)
        staged = materialize(staged, silver_path, "fiscal_year")
        write_table(files.rejects(), f"{folder}/validation/rejects")
        years |= _years(staged)
        schema = staged.schema
    if old:
        known = old.read(spark, "stg_ledger")
        years |= _years(known.where(moved_source))
        schema = schema or known.schema
        rest = known.where(F.col("fiscal_year").isin(sorted(years)) & ~moved_source)
        write_table(rest.select(*schema.names), silver_path, "fiscal_year", append=bool(to_read))
    silver = table("stg_ledger", schema, silver_path, sorted(years))
    silver_suite = SILVER_SUITE if silver_suite is None else silver_suite
    if silver_suite:
        checked(silver, silver_suite, "silver", f"{folder}/validation/silver")

    # Gold: dimensions whole, the fact and the yearly marts for the years concerned.
    dims = build_dims(silver, f"{folder}/gold")
    for name, dim in dims.items():
        tables[name], schemas[name] = [Part(f"{folder}/gold/{name}")], dim.schema.json()
        if old and name in CODES:
            was, code = old.read(spark, name), F.col(d.DIMENSIONS[name].key_name).alias(CODES[name])
            differs = was.exceptAll(dim).unionByName(dim.exceptAll(was)).select(code).distinct()
            years |= _years(silver.join(differs, CODES[name], "left_semi"))
    dates = sorted(years)
    touched = F.col("fiscal_year").isin(dates)
    fact = write("fct_transactions", fct_transactions(silver.where(touched), dims), dates)
    changed_lines = fact.where(touched)
    plan = m.mart_base(changed_lines, m.deal_size(changed_lines))
    dealt = {BASE: plan} | {name: mart(plan, dims) for name, mart in DEALT_MARTS.items()}
    paths = write_together(dealt, f"{folder}/gold/dealt")
    marts = {name: table(name, df.schema, paths[name], dates) for name, df in dealt.items()}
    base, summary = marts.pop(BASE), marts.pop(SUMMARY)
    own = base.where(touched)
    marts |= {name: write(name, mart(own, dims), dates) for name, mart in YEARLY_MARTS.items()}
    variance = m.variance_vs_prior_month(marts["int_department_spend_monthly"])
    marts["int_variance_features"] = write("int_variance_features", variance, None)
    budget = "mart_budget_variance_by_fund"
    marts[budget] = write(budget, m.budget_variance(base), None)
    if suite := GOLD_SUITE if gold_suite is None else gold_suite:
        checked(marts["kpi_monthly_summary"], suite, "gold", f"{folder}/validation/gold")
    tests = model_tests(silver, Gold(dims, fact, marts, base), targets, summary, silver_suite)
    run_tests(tests, f"{folder}/validation/models", warn_only)
    release = Release(number, tables, schemas, f"{folder}/manifest")
    publish(spark, out, release)
    return release
