from __future__ import annotations

from decimal import Decimal as D

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerspark import operators as op
from ledgerspark import plans

FACT = "fiscal_year int, fund_sk string, agency_sk string, ledger string, \
accounting_period int, amount decimal(18,2)"

fact_rows = st.lists(
    st.tuples(
        st.sampled_from([2022, 2023, None]),
        st.sampled_from(["f1", "f2", None]),
        st.sampled_from(["a1", None]),
        st.sampled_from(["ACTUALS", "BUDGET", "ENCUMBRANCE"]),
        st.sampled_from([0, 1, 2, 11, 12, 13, None]),
        st.one_of(st.none(), st.decimals(-1000, 1000, places=2)),
    ),
    max_size=25,
)
few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_signed_rollup_with_nulls(spark):
    data = [("a", None), ("b", D("2.50")), ("b", D("-1.00")), ("b", D("0.00")), ("b", None)]
    df = spark.createDataFrame(data, "k string, amount decimal(18,2)")
    expected = [
        ("a", D("0.00"), D("0.00"), None, 1),
        ("b", D("2.50"), D("-1.00"), D("1.50"), 4),
    ]
    assert rows(op.signed_rollup(df, ["k"])) == expected
    assert rows(op.signed_rollup(df, ["k"], inclusive_zero=False)) == expected
    types = dict(op.signed_rollup(df, ["k"]).dtypes)
    assert types["total_revenue"] == types["net_amount"] == "decimal(38,2)"


@few
@given(fact_rows)
def test_plan_vs_actual_is_a_full_outer_join(spark, data):
    fact = spark.createDataFrame(data, FACT)

    def side(ledger, name):
        sums = fact.where(F.col("ledger") == ledger).groupBy("fiscal_year", "fund_sk")
        return sums.agg(F.sum("amount").cast("decimal(38,2)").alias(name))

    a, b = side("ACTUALS", "a").alias("x"), side("BUDGET", "b").alias("y")
    zero = F.lit(0).cast("decimal(38,2)")
    pair = (F.coalesce("a", zero), F.coalesce("b", zero))
    values = [*pair, (pair[1] - pair[0]).cast("decimal(38,2)")]
    keys = ["fiscal_year", "fund_sk"]
    match = (F.col("x.fiscal_year") == F.col("y.fiscal_year")) & (
        F.col("x.fund_sk") == F.col("y.fund_sk")
    )
    outer = a.join(b, match, "full_outer").select(*[f"x.{k}" for k in keys], *values)
    assert rows(plans.budget_variance(fact)) == rows(outer)

    same = F.col("x.fiscal_year").eqNullSafe(F.col("y.fiscal_year")) & F.col(
        "x.fund_sk"
    ).eqNullSafe(F.col("y.fund_sk"))
    keyed = a.join(b, same, "full_outer").select(
        *[F.coalesce(f"x.{k}", f"y.{k}") for k in keys], *values
    )
    assert rows(plans.budget_variance_conformed(fact)) == rows(keyed)


@few
@given(fact_rows)
def test_missing_periods_is_scaffold_minus_data(spark, data):
    fact = spark.createDataFrame(data, FACT)
    scaffold = plans.completeness_scaffold(fact)
    keys = {(r[0], r[1], r[2]) for r in data}
    assert scaffold.count() == 12 * len(keys)
    seen = {(r[0], r[1], r[2], r[4]) for r in data}
    expected = sorted(
        (k + (p,) for k in keys for p in range(1, 13) if k + (p,) not in seen), key=str
    )
    assert rows(plans.missing_period_rows(fact)) == expected
    assert rows(op.missing_from(scaffold, fact)) == expected


def test_one_missing_period(spark):
    data = [(2024, "f", "a", "ACTUALS", p, D(1)) for p in range(1, 12)]
    fact = spark.createDataFrame(data, FACT)
    assert rows(plans.missing_period_rows(fact)) == [(2024, "f", "a", 12)]


def test_prior_period_delta(spark):
    data = [("d", 2022, 1, D("1.50")), ("d", 2022, 2, None), ("d", 2023, 1, D("2.00"))]
    df = spark.createDataFrame(data, "k string, y int, m int, t decimal(38,2)")
    got = op.prior_period_delta(df, ["k"], ["y", "m"], "t", "delta")
    assert [r.delta for r in got.orderBy("y", "m").collect()] == [D("1.50"), None, None]


@few
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", "c", None]),
            st.sampled_from(["x", "y", None]),
            st.decimals(-100, 100, places=2),
        ),
        max_size=15,
    ),
    st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("mnop")), max_size=8, unique=True),
    st.lists(st.tuples(st.sampled_from("xyz"), st.sampled_from("mn")), max_size=4, unique=True),
)
def test_weighted_sum_is_the_repeated_sum(spark, data, names_1, names_2):
    df = spark.createDataFrame(data, "k1 string, k2 string, amount decimal(18,2)")
    one = spark.createDataFrame(names_1, "d1 string, n1 string")
    two = spark.createDataFrame(names_2, "d2 string, n2 string")
    lookups = [op.Lookup(one, "k1", "d1", ["n1"]), op.Lookup(two, "k2", "d2", ["n2"])]
    joined = op.star_join(df, lookups, ["k1", "k2", "n1", "n2", "amount"])
    total = F.sum("amount").cast("decimal(38,2)")
    expected = joined.groupBy("k1").agg(total)
    assert rows(op.weighted_sum(df, lookups, ["k1"], "amount", "t")) == rows(expected)


def test_star_join_repeats_rows_per_name(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("a", "x"), ("a", "y")], "key string, name string")
    look = [op.Lookup(dim, "k", "key", ["name"])]
    left = op.star_join(fact, look, ["id", "name"])
    assert rows(left) == [(1, "x"), (1, "y"), (2, None), (3, None)]
    assert rows(op.star_join(fact, look, ["id", "name"], "inner")) == [(1, "x"), (1, "y")]
    assert rows(op.one_name_per_key(dim, "key", "name")) == [("a", "x")]


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",), (None,)], "pk string")
    assert rows(op.orphan_rows(child, "fk", parent, "pk")) == [("b",), ("b",)]
    assert rows(op.orphan_keys(child, "fk", parent, "pk")) == [("b", 2)]


def test_allowed_pairs(spark):
    data = [
        ("019000", "531110"),
        ("019000", "999999"),
        ("019000", None),
        ("X", "anything"),
        (None, "531110"),
    ]
    df = spark.createDataFrame(data, "fund string, account string")
    rules = {"019000": ["531110", "531120"], "021000": ["552110"]}
    expected = [("019000", "999999")]
    assert rows(op.allowed_pairs(df, "fund", "account", rules)) == expected
    table = spark.createDataFrame([(k, v) for k, vs in rules.items() for v in vs], ["key", "value"])
    assert rows(op.allowed_pairs(df, "fund", "account", table)) == expected


def test_reconcile(spark):
    data = [
        (2024, D("10.00")),
        (2024, D("0.00")),
        (2024, D("-4.00")),
        (2023, D("1.00")),
        (2024, None),
    ]
    fact = spark.createDataFrame(data, "fiscal_year int, amount decimal(18,2)")
    targets = spark.createDataFrame(
        [
            ("total_revenue", 2024, D("10.01")),
            ("total_expenses", 2024, D("-4.02")),
            ("total_revenue", 2020, D("5.00")),
        ],
        "metric_name string, fiscal_year int, expected_value_usd decimal(18,2)",
    )
    off = ("total_expenses", 2024, D("-4.00"), D("-4.02"))
    assert rows(op.reconcile(fact, targets)) == [off]
    strict = rows(op.reconcile(fact, targets, require_all=True))
    unmatched = [
        ("total_revenue", 2020, None, D("5.00")),
        ("total_revenue", 2023, D("1.00"), None),
    ]
    assert strict == sorted([off, *unmatched], key=str)


def test_null_comparisons_pass(spark):
    df = spark.createDataFrame([(1, None), (1, 1), (1, 2)], "a int, b int")
    assert rows(op.expression_violations(df, "a = b")) == [(1, 2)]
    assert rows(op.unequal_columns(df, F.col("a"), F.col("b"))) == [(1, 2)]
    safe = op.unequal_columns(df, F.col("a"), F.col("b"), null_safe=True)
    assert rows(safe) == [(1, 2), (1, None)]
    assert rows(op.unexpected_values(df, "b", [1])) == [(2, 1)]
    assert rows(op.duplicate_values(df, "a")) == [(1, 3)]


def test_top_groups_and_trend(spark):
    data = [("a", 1), ("b", 3), ("c", 3), (None, 2), ("d", None)]
    df = spark.createDataFrame(data, "k string, v int")
    top = op.top_groups(df, "k", F.sum("v"), "total", 3)
    assert [r.k for r in top.collect()] == ["b", "c", None]
    ts = df.withColumn("t", F.expr("timestamp_ntz'2024-05-17 10:00:00'"))
    trend = op.monthly_trend(ts, "t", F.count(F.lit(1)), "n")
    assert dict(trend.dtypes)["month"] == "timestamp_ntz"
    assert [(str(r.month), r.n) for r in trend.collect()] == [("2024-05-01 00:00:00", 5)]


def test_dedupe(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert rows(op.dedupe_on_key(df, "k", ["v"])) == [("a", 1), ("b", 3)]
    assert rows(op.dedupe_on_key(df.withColumn("w", -F.col("v")), "k", ["w"]).drop("w")) == [("a", 2), ("b", 3)]


def test_periods_outside_the_months(spark):
    df = spark.createDataFrame([("a", 100), ("a", 7), ("b", -1)], "k string, p int")
    assert rows(op.missing_periods(df, ["k"], "p", (-1, 100))) == [("a", -1), ("b", 100)]


def test_empty_rule_allows_nothing(spark):
    df = spark.createDataFrame([("f", "1"), ("f", None), ("g", "1")], "k string, v string")
    assert rows(op.allowed_pairs(df, "k", "v", {"f": []})) == [("f", "1")]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (4, "a")], "n int, s string")
    exact = {r.column_name: r for r in op.table_profile(df, exact=True).collect()}
    approx = {r.column_name: r for r in op.table_profile(df).collect()}
    assert exact == approx
    n, s = exact["n"], exact["s"]
    assert (n.row_count, n.null_count, n.distinct_count, n.min, n.max) == (3, 0, 3, "1", "4")
    assert n.mean == pytest.approx(7 / 3)
    assert (s.null_count, s.distinct_count, s.min, s.mean) == (1, 1, "a", None)
    assert rows(op.table_shape(df)) == [(3, 2)]
