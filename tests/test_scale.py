"""What the layers shuffle and sort: not more than their results need."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from ledgerspark import operators as op
from ledgerspark import plans
from ledgerspark.checks.registry import QUERIES
from ledgerspark.checks.sample_ledger import layers
from ledgerspark.plans import marts, pipeline
from ledgerspark.plans.pipeline import key_summary
from ledgerspark.sources.csv_files import read_csv_by_name, write_csv
from ledgerspark.sources.tables import materialize, open_partitions

SMALL = "/root/testdata/sf0.001"
SETTING = "spark.sql.maxConcurrentOutputFileWriters"


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_raw_lines_are_not_gathered_by_file(spark):
    x = layers(spark, SMALL)
    assert "RebalancePartitions" not in plan_of(x.raw)
    parts = [p.name for p in Path(x.csv_root).glob("file=*/part-*")]
    assert parts and all(name.endswith(".csv.gz") for name in parts)


def test_compressed_parts_are_one_file(spark, tmp_path):
    df = spark.range(40).selectExpr("cast(id as string) as k", "concat('f', id % 3, '.csv') as file").repartition(4)
    write_csv(df, str(tmp_path / "raw"), ["file"], compression="gzip")
    back = read_csv_by_name(spark, str(tmp_path / "raw"), "file=*.csv")
    assert sorted((r.k, r.source_path) for r in back.collect()) == sorted((r.k, r.file) for r in df.collect())


def test_written_partitions_keep_their_order(spark, tmp_path):
    """Rows of a task are not sorted by partition before they are written."""
    rows = spark.range(1000, numPartitions=1).withColumn("year", (F.col("id") * 7 % 5).cast("int"))
    back = materialize(rows, str(tmp_path / "t"), "year")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    before = spark.conf.get(SETTING, None)
    with open_partitions(spark, 3):
        assert spark.conf.get(SETTING) == "3"
        many = materialize(rows, str(tmp_path / "u"), "id")  # more values than files: Spark sorts
    assert spark.conf.get(SETTING, None) == before
    assert many.count() == 1000


def test_weighted_sum_shuffles_weights_not_keys(spark):
    rows = spark.range(100).selectExpr("id % 2 as d", "id as wide", "cast(1 as decimal(18,2)) as amount")
    names = spark.createDataFrame([(3, "a"), (3, "b"), (5, "a")], "key long, name string")
    lookups = [op.Lookup(names, "wide", "key", ["name"]), op.Lookup(names, "d", "key", ["name"])]
    sums = op.weighted_sum(rows, lookups, ["d"], "amount", "t")
    assert {(r.d, str(r.t)) for r in sums.collect()} == {(0, "50.00"), (1, "51.00")}
    inner = [line for line in plan_of(sums).splitlines() if "Aggregate [" in line and "__sum" in line.split("], [")[-1]]
    assert inner and not any("wide" in line.split("], [")[0] for line in inner)


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_base_is_dealt_out_once(spark):
    """Lines are shuffled as they are, and what groups by department and month shuffles nothing again."""
    x = layers(spark, SMALL)
    base = plans.mart_base(x.fact)
    plan = executed(base)
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "HashAggregate" not in below
    assert executed(key_summary(base)).count("Exchange hashpartitioning") == 1
    keys = ["fiscal_year", "accounting_period", *["agency_sk", "fund_sk", "department_sk", "account_sk"]]
    plain = x.fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    ours = key_summary(plans.mart_base(x.fact, 3)).select(*keys, "rows")
    assert not ours.exceptAll(plain).count() and not plain.exceptAll(ours).count()


def test_base_is_dealt_by_its_lines(spark, tmp_path, monkeypatch):
    """A task groups a bounded number of lines, and not as many as the session's partitions leave to it."""
    x = layers(spark, SMALL)
    monkeypatch.setattr(marts, "LINES_A_TASK", 300)
    whole = x.fact.count() // 300 + 1
    assert whole > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert plans.deal_size(x.fact) == whole
    assert plans.deal_size(x.fact.limit(0)) == 1
    assert f", {whole}), REPARTITION_BY_NUM" in executed(QUERIES["mart_base"](spark, SMALL))
    monkeypatch.setattr(pipeline, "fct_transactions", lambda silver, dims: x.fact)
    seen = []
    monkeypatch.setattr(pipeline, "mart_plans", lambda fact, dims, base: seen.append(base) or {})
    real = marts.mart_base
    monkeypatch.setattr(marts, "mart_base", lambda fact, n=None: seen.append(n) or real(fact, n))
    pipeline.build_gold(x.silver, str(tmp_path / "gold"))
    assert seen[0] == whole
    assert not seen[1].exceptAll(real(x.fact)).count() and not real(x.fact).exceptAll(seen[1]).count()


def test_unique_values_do_not_move(spark):
    """The values are let into the join only once a repeated fingerprint has been found."""
    rows = spark.range(1000).selectExpr("cast(id as string) as v")
    found = op.duplicate_values(rows, "v")
    assert "scalar-subquery" in plan_of(found)
    assert found.collect() == []
    twice = rows.unionByName(rows.where("v in ('3', '700')"))
    assert sorted(map(tuple, op.duplicate_values(twice, "v").collect())) == [("3", 2), ("700", 2)]
