"""A contract checks NULL flags and bounds, whether it stops the job or reports."""

from __future__ import annotations

import pytest

from ledgerspark import operators as op
from ledgerspark.checks.registry import QUERIES
from ledgerspark.operators.quality import ContractField

CONTRACT = [
    ContractField("amount", "double"),
    ContractField("year", "int", ge=2000, le=2050),
    ContractField("note", "string", nullable=True),
]
ROWS = [
    ("1.5", "2000", None, 1), ("2", "2050", "x", 2), (None, "2024", "", 3),
    ("3", "1999", None, 4), (None, "2051", None, 5), ("4", None, "y", 6),
]


def test_rows_name_the_rules_they_break(spark):
    df = spark.createDataFrame(ROWS, "amount string, year string, note string, extra int")
    judged = op.apply_contract(df, CONTRACT, broken="why")
    assert judged.dtypes == [("amount", "double"), ("year", "int"), ("note", "string"), ("why", "string")]
    assert [r.why for r in judged.collect()] == [
        None, None, "amount not null", "year >= 2000", "amount not null; year <= 2050", "year not null",
    ]


@pytest.mark.parametrize("row, why", [(2, "amount not null"), (3, "year >= 2000"), (4, "year <= 2050")])
def test_a_row_that_breaks_a_rule_stops_the_job(spark, row, why):
    df = spark.createDataFrame(ROWS, "amount string, year string, note string, extra int")
    kept = op.apply_contract(df.where("extra <= 2"), CONTRACT)
    assert [tuple(r) for r in kept.collect()] == [(1.5, 2000, None), (2.0, 2050, "x")]
    with pytest.raises(Exception, match=why):
        op.apply_contract(df.where(df.extra == row + 1), CONTRACT).count()


def test_the_query_judges_every_row(spark):
    judged = QUERIES["schema_contract"](spark, "/root/testdata/sf0.001")
    assert judged.where("(fiscal_year >= 2000 and quarter between 1 and 4) <> (broken_rules is null)").count() == 0
    assert judged.where("broken_rules = 'fiscal_year >= 2000; quarter <= 4'").count() > 0
