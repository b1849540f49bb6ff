"""Time the registered queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores.
The written layers (raw CSV, silver, dimensions, fact, KPI mart) are timed as
``build_*``; every query is then run once over them. ``BENCH_DUCKDB=1`` also times
DuckDB on the same cores, with the same layers as tables.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from ledgerspark.checks.oracle import ORACLE_SQL, TABLES
from ledgerspark.checks.registry import QUERIES
from ledgerspark.checks.sample_ledger import layers
from ledgerspark.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
BUILD = {"build_raw_csv": "csv_root", "build_silver": "silver", "build_dims": "dims"}
BUILD |= {"build_fact": "fact", "build_kpi": "kpi"}
TEST_TABLES = "region nation customer supplier part orders lineitem events documents".split()


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def run_spark() -> dict[str, float]:
    spark = local_session(CPUS, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    x = layers(spark, SF_DIR)
    seconds = {name: timed(lambda a=a: getattr(x, a)) for name, a in BUILD.items()}
    for name, query in QUERIES.items():
        seconds[name] = timed(
            lambda q=query: q(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )
    spark.stop()
    return seconds


def run_duckdb() -> dict[str, float]:
    import duckdb

    con = duckdb.connect(f"{tempfile.mkdtemp(prefix='bench-')}/bench.duckdb")
    con.execute(f"set threads = {CPUS}")
    for name in TEST_TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")

    def store(*names: str) -> None:
        for name in names:
            con.execute(f"create table {name} as {TABLES[name][1]}")

    seconds = {
        "build_silver": timed(lambda: store("tidy_raw", "raw", "silver")),
        "build_dims": timed(lambda: store("agencies", "funds", "departments", "accounts")),
        "build_fact": timed(lambda: store("fact")),
        "build_kpi": timed(lambda: store("kpi")),
    }
    stored = {"tidy_raw", "raw", "silver", "agencies", "funds", "departments", "accounts", "fact", "kpi"}
    for name, text in ORACLE_SQL.items():
        rest = [t for t in getattr(text, "reads", []) if t not in stored]
        ctes = ", ".join(f"{t} as ({TABLES[t][1]})" for t in rest)
        select = getattr(text, "select", text)
        query = f"with {ctes} {select}" if ctes else select
        seconds[name] = timed(
            lambda q=query: con.execute(f"create or replace temp table result as {q}")
        )
    return seconds


def main() -> None:
    seconds = run_spark()
    report = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "cpus": CPUS,
    }
    if os.environ.get("BENCH_DUCKDB") == "1":
        report["duckdb"] = run_duckdb()
    json.dump(report, sys.stdout)
    print()


if __name__ == "__main__":
    main()
