"""Expectation suites: many checks on a table in one aggregation.

A suite is a list of ``Expectation``. All checks but uniqueness become columns of
a single ``df.agg``; uniqueness needs its own shuffle on the checked column. Only
one row per expectation leaves the executors.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.rules import duplicate_values

EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
VALUES_BETWEEN = "expect_column_values_to_be_between"
MIN_BETWEEN = "expect_column_min_to_be_between"
MAX_BETWEEN = "expect_column_max_to_be_between"
EQUAL_TO = "expect_column_to_equal_expression"
EXPRESSION = "expect_expression_to_be_true"

RESULT_SCHEMA = (
    "expectation string, column string, success boolean, element_count bigint, "
    "unexpected_count bigint, observed_value string"
)


@dataclass(frozen=True)
class Expectation:
    """One check. ``mostly`` is the share of non-NULL values that must pass.

    ``expression`` is SQL text: the value to equal for ``EQUAL_TO``, the condition
    for ``EXPRESSION`` (``column`` is then only a label).
    """

    kind: str
    column: str
    values: tuple = ()
    min_value: object = None
    max_value: object = None
    strict: bool = False
    mostly: float = 1.0
    expression: str = ""


class SuiteFailed(RuntimeError):
    """A gate met failed expectations; ``failed`` holds their result rows."""

    def __init__(self, name: str, failed: list) -> None:
        lines = [
            f"{r.expectation}({r.column}): unexpected={r.unexpected_count} "
            f"observed={r.observed_value}"
            for r in failed
        ]
        super().__init__(f"{name}: {len(failed)} failed expectations\n" + "\n".join(lines))
        self.failed = failed


def within(c: Column, low: object, high: object, strict: bool = False) -> Column:
    """True when ``c`` lies in the bounds given; a missing bound does not limit."""
    bounds = []
    if low is not None:
        bounds.append(c > low if strict else c >= low)
    if high is not None:
        bounds.append(c < high if strict else c <= high)
    return reduce(lambda a, b: a & b, bounds, F.lit(True))


def _passes(e: Expectation) -> Column:
    """Row-wise condition of a per-value check; NULL counts as passed."""
    c = F.col(e.column) if e.kind != EXPRESSION else None
    if e.kind == NOT_NULL:
        return c.isNotNull()
    if e.kind == IN_SET:
        return F.when(c.isNotNull(), c.isin([v for v in e.values if v is not None]))
    if e.kind == VALUES_BETWEEN:
        return F.when(c.isNotNull(), within(c, e.min_value, e.max_value, e.strict))
    if e.kind == EQUAL_TO:
        return c == F.expr(e.expression)
    if e.kind == EXPRESSION:
        return F.expr(e.expression)
    raise ValueError(f"unknown expectation {e.kind}")


def _result(
    e: Expectation, success: Column, unexpected: Column | None = None, observed: Column | None = None
) -> Column:
    return F.struct(
        F.lit(e.kind).alias("expectation"),
        F.lit(e.column).alias("column"),
        F.coalesce(success, F.lit(False)).alias("success"),
        F.col("n").alias("element_count"),
        (F.lit(None).cast("long") if unexpected is None else unexpected).alias("unexpected_count"),
        (F.lit(None) if observed is None else observed).cast("string").alias("observed_value"),
    )


def _compile(e: Expectation, i: int, present: bool) -> tuple[list[Column], Column]:
    """Aggregates an expectation needs and its result in terms of them."""
    if e.kind == EXISTS:
        return [], _result(e, F.lit(present))
    if not present:
        return [], _result(e, F.lit(False), observed=F.lit("column missing"))
    if e.kind in (MIN_BETWEEN, MAX_BETWEEN):
        extreme = F.min if e.kind == MIN_BETWEEN else F.max
        observed = F.col(f"obs{i}")
        ok = within(observed, e.min_value, e.max_value, e.strict) & observed.isNotNull()
        return [extreme(e.column).alias(f"obs{i}")], _result(e, ok, observed=observed)
    passes = _passes(e)
    judged = F.lit(True) if e.kind == NOT_NULL else passes.isNotNull()
    bad, total = F.col(f"bad{i}"), F.col(f"total{i}")
    aggs = [F.count_if(~passes).alias(f"bad{i}"), F.count_if(judged).alias(f"total{i}")]
    share = F.try_divide(total - bad, total)
    return aggs, _result(e, (total == 0) | (share >= e.mostly), unexpected=bad)


def _uniqueness(df: DataFrame, e: Expectation) -> DataFrame:
    """Counts every row of a duplicated non-NULL value as unexpected."""
    repeated = duplicate_values(df, e.column).agg(F.coalesce(F.sum("records"), F.lit(0)))
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count(e.column).alias("total"))
    counts = counts.select("n", "total", repeated.scalar().alias("bad"))
    bad, total = F.col("bad"), F.col("total")
    ok = (total == 0) | (F.try_divide(total - bad, total) >= e.mostly)
    return counts.select(_result(e, ok, unexpected=bad).alias("r")).select("r.*")


def _present(df: DataFrame, e: Expectation) -> bool:
    """Whether the table has the columns that a check names."""
    if e.kind != EXPRESSION and e.column not in df.columns:
        return False
    if e.kind in (EXPRESSION, EQUAL_TO):
        try:
            df.select(F.expr(e.expression)).schema  # noqa: B018  Spark resolves the names
        except AnalysisException as error:
            if str(error.getCondition()).startswith("UNRESOLVED_COLUMN"):
                return False
            raise
    return True


def run_suite(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One result row per expectation (``RESULT_SCHEMA``).

    A check on a column the table lacks fails. NULL values pass every check but
    not-null. A minimum or maximum of no values fails.
    """
    columns = set(df.columns)
    unique = [e for e in suite if e.kind == UNIQUE and e.column in columns]
    aggs, results = [F.count(F.lit(1)).alias("n")], []
    for i, e in enumerate(suite):
        if e not in unique:
            more, result = _compile(e, i, _present(df, e))
            aggs += more
            results.append(result)
    parts = [_uniqueness(df, e) for e in unique]
    if results:
        measured = df.agg(*aggs)
        parts.insert(0, measured.select(F.explode(F.array(*results)).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def statistics(results: DataFrame) -> DataFrame:
    """Evaluated, successful and unsuccessful expectations and the success percent."""
    return results.agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if("success").alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
        F.try_divide(F.count_if("success") * 100.0, F.count(F.lit(1)).cast("double")).alias(
            "success_percent"
        ),
    )


def failures(results: DataFrame) -> DataFrame:
    return results.where(~F.col("success"))


def write_results(results: DataFrame, path: str) -> DataFrame:
    """Save the results as JSON and return the saved rows, so nothing is rerun."""
    results.coalesce(1).write.mode("overwrite").json(path)
    return results.sparkSession.read.schema(RESULT_SCHEMA).json(path)


def gate(results: DataFrame, name: str = "suite") -> None:
    """Raise SuiteFailed unless every expectation holds.

    The rows brought to the driver number at most one per expectation.
    """
    failed = failures(results).collect()
    if failed:
        raise SuiteFailed(name, failed)


@dataclass(frozen=True)
class ContractField:
    """Declared column: type, whether NULL is allowed, and optional bounds."""

    name: str
    dtype: str
    nullable: bool = False
    ge: object = None
    le: object = None


def _value_rules(field: ContractField, value: Column, missing: Column) -> list[tuple[str, Column]]:
    """(rule, condition of its failure) for the NULL flag and the bounds of one column."""
    rules = [] if field.nullable else [("not null", missing)]
    if field.ge is not None:
        rules.append((f">= {field.ge}", value < field.ge))
    if field.le is not None:
        rules.append((f"<= {field.le}", value > field.le))
    return rules


def apply_contract(
    df: DataFrame, contract: list[ContractField], broken: str | None = None
) -> DataFrame:
    """Declared columns only, cast to their declared types, with NULL flags and bounds checked.

    Raises ValueError for an absent column; a value that cannot be cast fails the job, and so does a
    row that breaks a rule. With ``broken`` all rows stay, and the column of that name lists the
    rules that a row breaks, NULL for none.
    """
    absent = [f.name for f in contract if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns missing from table: {absent}")
    fitted = df.select(*[F.col(f.name).cast(f.dtype).alias(f.name) for f in contract])
    texts = [
        F.when(fails, F.lit(f"{f.name} {rule}"))
        for f in contract
        for rule, fails in _value_rules(f, F.col(f.name), F.col(f.name).isNull())
    ]
    found = F.nullif(F.concat_ws("; ", *texts), F.lit(""))
    if broken is not None:
        return fitted.withColumn(broken, found)
    outside = F.raise_error(F.concat(F.lit("a row breaks the contract: "), found))
    return fitted.where(F.when(found.isNull(), True).otherwise(outside.cast("boolean")))


def contract_suite(contract: list[ContractField]) -> list[Expectation]:
    """The contract's NULL and range rules as expectations."""
    suite = [Expectation(NOT_NULL, f.name) for f in contract if not f.nullable]
    return suite + [
        Expectation(VALUES_BETWEEN, f.name, min_value=f.ge, max_value=f.le)
        for f in contract
        if f.ge is not None or f.le is not None
    ]


def contract_violations(df: DataFrame, contract: list[ContractField]) -> DataFrame:
    """Result rows of the contract's rules on a table that fits it."""
    return run_suite(apply_contract(df, contract, broken="__broken"), contract_suite(contract))


FAILURE_CASES = "row_id string, column_name string, rule string, value string"


def _contract_cases(field: ContractField) -> list[tuple[str, Column]]:
    """(rule, condition of its failure) for one column; a value that is no such type fails only that."""
    raw = F.col(field.name)
    value = raw.try_cast(field.dtype)
    rules = [(f"type {field.dtype}", raw.isNotNull() & value.isNull())]
    return rules + _value_rules(field, value, raw.isNull())


def split_by_contract(
    df: DataFrame, contract: list[ContractField], row_id: str
) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, cast to it, and the failure cases of all others.

    The cases (``FAILURE_CASES``) name the row, column, rule and the value as it came; a row has one for
    each rule it breaks. No bad value ends the job. Both tables are plans over ``df`` without a
    shuffle; every row is in exactly one of them, null and repeated ids included. Raises
    ValueError for an absent column.
    """
    absent = [f.name for f in contract if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns missing from table: {absent}")
    cases = [
        F.when(
            fails,
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(rule).alias("rule"),
                F.col(field.name).cast("string").alias("value"),
            ),
        )
        for field in contract
        for rule, fails in _contract_cases(field)
    ]
    judged = df.withColumn("__cases", F.array_compact(F.array(*cases)))
    typed = [F.col(f.name).try_cast(f.dtype).alias(f.name) for f in contract]
    accepted = judged.where(F.size("__cases") == 0).select(*typed)
    rows = judged.where(F.size("__cases") > 0)
    return accepted, rows.select(F.col(row_id).cast("string").alias("row_id"), F.inline("__cases"))


def suite_to_json(suite: list[Expectation], name: str) -> str:
    """A suite in the stored form: type, arguments and notes of every expectation."""
    stored = []
    for e in suite:
        kwargs: dict[str, object] = {"column": e.column}
        if e.kind == IN_SET:
            kwargs["value_set"] = [_plain_value(v) for v in e.values]
        for key in ("min_value", "max_value"):
            if (bound := getattr(e, key)) is not None:
                kwargs[key] = _plain_value(bound)
        if e.strict:
            kwargs |= {"strict_min": True, "strict_max": True}
        if e.mostly != 1.0:
            kwargs["mostly"] = e.mostly
        if e.expression:
            kwargs["expression"] = e.expression
        stored.append({"expectation_type": e.kind, "kwargs": kwargs, "meta": {}})
    return json.dumps({"data_asset_type": None, "expectation_suite_name": name, "expectations": stored}, indent=2)


def _plain_value(value: object) -> object:
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else str(value)
    return value


KINDS = {EXISTS, NOT_NULL, UNIQUE, IN_SET, VALUES_BETWEEN, MIN_BETWEEN, MAX_BETWEEN, EQUAL_TO, EXPRESSION}
ARGUMENTS = {"column", "value_set", "min_value", "max_value", "strict_min", "strict_max", "mostly", "expression"}


def suite_from_json(text: str) -> list[Expectation]:
    """The expectations of a stored suite; an unknown type or argument is an error, not a passed check."""
    suite = []
    for stored in json.loads(text, parse_float=Decimal)["expectations"]:
        kind, kwargs = stored["expectation_type"], stored["kwargs"]
        if kind not in KINDS or not set(kwargs) <= ARGUMENTS:
            raise ValueError(f"cannot run {kind} with {sorted(kwargs)}")
        strict = {bool(kwargs[k]) for k in ("strict_min", "strict_max") if k in kwargs}
        if len(strict) > 1:
            raise ValueError(f"{kind}: bounds are strict both or neither")
        suite.append(
            Expectation(
                kind,
                kwargs["column"],
                values=tuple(kwargs.get("value_set") or ()),
                min_value=kwargs.get("min_value"),
                max_value=kwargs.get("max_value"),
                strict=True in strict,
                mostly=float(kwargs.get("mostly", 1.0)),
                expression=kwargs.get("expression", ""),
            )
        )
    return suite


def write_suite(spark: SparkSession, suite: list[Expectation], path: str, name: str) -> None:
    """Store a suite as JSON text below ``path``."""
    frame = spark.createDataFrame([(suite_to_json(suite, name),)], "value string")
    frame.coalesce(1).write.mode("overwrite").text(path)


def read_suite(spark: SparkSession, path: str) -> list[Expectation]:
    """The suite stored in a JSON file, or in the folder that ``write_suite`` has written."""
    (row,) = spark.read.text(path, wholetext=True).collect()
    return suite_from_json(row.value)
