"""Plans: what is pruned, what is shuffled, and how a hot key is handled."""

from __future__ import annotations

import contextlib
import io
from types import SimpleNamespace

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from ledgerspark import plans
from ledgerspark.checks.sample_ledger import layers
from ledgerspark.operators import allowed_pairs
from ledgerspark.plans.pipeline import build_dims
from ledgerspark.session import fresh_path, shared_dir
from ledgerspark.sources import materialize

SF_DIR = "/root/testdata/sf0.001"


def explained(df, run=False):
    if run:
        df.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="extended" if run else "formatted")
    text = out.getvalue()
    return text.split("Physical Plan")[-1] if run else text


@contextlib.contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def without_broadcast(spark, **more):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        **more,
    )


@pytest.fixture(scope="module")
def x(spark):
    return layers(spark, SF_DIR)


def test_filters_and_columns_reach_the_scan(x):
    df = plans.filtered_rollup(x.fact, x.dims, fiscal_year=1998, fund_code="AUT")
    plan = explained(df)
    assert "(fiscal_year#" in plan and "= 1998)" in plan.split("PartitionFilters")[1]
    assert "EqualTo(fund_sk," in plan
    fact_schema = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "amount" in fact_schema and "budget_ref" not in fact_schema


def test_single_shuffle_where_the_definition_has_several(x):
    for df in (plans.budget_variance(x.fact), plans.missing_period_rows(x.fact)):
        plan = explained(df)
        assert plan.count("Exchange\n") + plan.count("Exchange (") <= 2
        assert "Join" not in plan


def test_dimensions_are_broadcast_by_their_size(spark, x):
    df = plans.fct_transactions(x.silver, x.dims)
    assert explained(df, run=True).count("BroadcastHashJoin") >= 4
    with without_broadcast(spark):
        df = plans.fct_transactions(x.silver, x.dims)
        plan = explained(df, run=True)
        assert "Broadcast" not in plan
        assert "SortMergeJoin" in plan


def test_rules_do_not_shuffle_the_ledger(x):
    df = allowed_pairs(x.silver, "fund_code", "account", {"AUT": ["1"]})
    plan = explained(df, run=True)
    assert "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_no_plan_multiplies_rows(spark):
    for name, query in entry_points.queries().items():
        plan = explained(query(spark, SF_DIR))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan, name


@pytest.mark.parametrize(
    "name",
    [
        "fct_transactions",
        "transactions_decorated",
        "kpi_monthly_summary",
        "mart_agency_fund_year",
        "department_rollup",
        "weighted_fanout",
        "fct_fanout",
        "relationships_violation_rows",
        "allowed_pairs",
        "reconcile_targets",
    ],
)
def test_results_without_broadcast(spark, name):
    with without_broadcast(spark):
        result = entry_points.queries()[name](spark, SF_DIR).toArrow()
    duck = compare.connect(SF_DIR)
    assert compare.multiset_diff(duck, result, entry_points.oracle_sql()[name]) == []


def test_hot_department_is_split(spark, x):
    """A department with half of all lines, and dimensions too large to broadcast."""
    hot = F.col("account") < "4"
    silver = x.silver.withColumns(
        {
            "dept_id": F.when(hot, "HOT").otherwise(F.col("dept_id")),
            "dept_descr": F.when(hot, "Hot department").otherwise(F.col("dept_descr")),
        }
    )
    path = fresh_path(spark, "hot")
    silver = materialize(silver, f"{path}/silver", "fiscal_year")
    dims = build_dims(silver, path)
    with without_broadcast(
        spark,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        fact = plans.fct_transactions(silver, dims)
        assert "SortMergeJoin(skew=true)" in explained(fact, run=True)
        split = fact.toArrow()
    whole = plans.fct_transactions(silver, dims).toArrow()
    key = [(c, "ascending") for c in whole.column_names]
    assert split.sort_by(key).equals(whole.sort_by(key))


def fake_session(setting, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting),
        sparkContext=SimpleNamespace(
            master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: None
        ),
    )


def test_shared_folder_comes_from_the_session():
    cluster = fake_session("s3a://shared/tables/", "yarn")
    assert shared_dir(cluster) == "s3a://shared/tables"
    assert fresh_path(cluster, "t") != fresh_path(cluster, "t")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake_session(None, "yarn"))
    local = fake_session(None, "local[2]")
    assert shared_dir(local) == shared_dir(local)
