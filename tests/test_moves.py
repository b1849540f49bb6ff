"""What a line carries when joins move it."""

from __future__ import annotations

import datetime
import re
import shutil

from pyspark.sql import functions as F

from ledgerspark import operators as op
from ledgerspark.checks.sample_ledger import layers, raw_ledger
from ledgerspark.operators.joins import ESCAPE, SEPARATOR

SMALL = "/root/testdata/sf0.001"
ODD_TEXTS = ["", " ", None, "a", SEPARATOR, ESCAPE, f"{ESCAPE}n", f"{ESCAPE}s{SEPARATOR}e{ESCAPE}", "é\n,\"'\\"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def joins_of(df) -> list[str]:
    """Conditions of the joins, the last one first."""
    return re.findall(r"Join \w+, \((?:.*?)(\w+)#\w+ = ", plan_of(df))


def test_packed_columns_come_back(spark):
    day = datetime.date(1998, 2, 6)
    rows = [(i, a, b, n, d) for i, a in enumerate(ODD_TEXTS) for b in ODD_TEXTS for n, d in ((7, day), (None, None))]
    df = spark.createDataFrame(rows, "i long, a string, b string, n int, d date")
    packed = op.pack(df, "p", ["b", "n", "a", "d"])
    assert packed.columns == ["i", "p"]
    back = op.unpack(packed, "p", [df.schema[c] for c in ("b", "n", "a", "d")])
    assert [f.dataType for f in back.select(*df.columns).schema] == [f.dataType for f in df.schema]
    order = lambda row: tuple((v is not None, v) for v in row)
    assert sorted(back.select(*df.columns).collect(), key=order) == sorted(df.collect(), key=order)
    one = op.unpack(op.pack(df.select("a"), "p", ["a"]), "p", [df.schema["a"]])
    assert not one.exceptAll(df.select("a")).count()
    none = packed.select(F.lit(None).cast("string").alias("p")).limit(1)
    assert op.unpack(none, "p", [df.schema["a"], df.schema["n"]]).collect() == [(None, None)]


def test_raw_lines_carry_little(spark):
    """Lines meet suppliers, parts and then orders; the columns with few values are one text a table."""
    raw = raw_ledger(spark, SMALL)
    keys = [k for k in joins_of(raw) if k.startswith("l_")]
    assert keys == ["l_orderkey", "l_partkey", "l_suppkey"]
    moved = [line for line in plan_of(raw).splitlines() if "__line#" in line and "__part#" in line]
    assert moved and not any(c in moved[-1] for c in ("p_name#", "l_returnflag#", "l_extendedprice#"))


def test_raw_lines_keep_odd_texts(spark, tmp_path):
    """Separators, escapes and missing values of parts and lines reach the ledger as they are."""
    for name in ("customer", "supplier", "nation", "orders"):
        shutil.copy(f"{SMALL}/{name}.parquet", tmp_path)
    texts = F.array(*[F.lit(t) for t in ODD_TEXTS])

    def odd(c: str):
        return F.get(texts, (F.col(c) % len(ODD_TEXTS)).cast("int"))

    parts = spark.read.parquet(f"{SMALL}/part.parquet").withColumns(
        {"p_name": odd("p_partkey"), "p_type": odd("p_partkey"), "p_size": F.nullif("p_size", F.lit(1))}
    )
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").withColumn("l_linestatus", odd("l_orderkey"))
    parts.write.parquet(f"{tmp_path}/part.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    row_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    wanted = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .where(F.col("l_orderkey") % 101 != 8)
        .select(row_id, "p_name", "p_type", F.col("p_size").cast("string"), "l_linestatus")
    )
    raw = raw_ledger(spark, str(tmp_path)).where("trim(ROWID) <> ''")
    found = raw.select("ROWID", "PRODUCTDESCR", "PGMDESCR", "PRODUCT", "ACTIVITY")
    assert wanted.count() and not found.exceptAll(wanted).count() and not wanted.exceptAll(found).count()


def test_fact_meets_departments_first(spark):
    """The join for which lines may have to move comes before those that widen or repeat them."""
    from ledgerspark.plans import fct_transactions

    x = layers(spark, SMALL)
    assert joins_of(fct_transactions(x.silver, x.dims))[-1] == "dept_id"
