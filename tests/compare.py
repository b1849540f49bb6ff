"""Compare a Spark result with its SQL: columns, types, row count and every value."""

from __future__ import annotations

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

TYPE_NAMES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def spark_rows(df) -> pa.Table:
    return df.toArrow()


def multiset_diff(con, left: pa.Table, sql: str) -> list[str]:
    """Problems found, empty when both sides hold the same rows."""
    con.register("spark_side", left)
    right = con.sql(sql)
    types = dict(zip(right.columns, [str(t) for t in right.types], strict=True))
    ours = con.sql("select * from spark_side")
    our_types = dict(zip(ours.columns, [str(t) for t in ours.types], strict=True))
    problems = []
    if sorted(types) != sorted(our_types):
        return [f"columns differ: {sorted(our_types)} vs {sorted(types)}"]
    for c in types:
        if types[c] != our_types[c]:
            problems.append(f"type of {c}: {our_types[c]} vs {types[c]}")
    cols = ", ".join(f'"{c}"' for c in sorted(types))
    con.execute(f"create or replace temp table sql_side as select {cols} from ({sql})")
    n_left = left.num_rows
    n_right = con.sql("select count(*) from sql_side").fetchall()[0][0]
    if n_left != n_right:
        problems.append(f"rows: {n_left} vs {n_right}")
    extra = con.sql(
        f"select count(*) from (select {cols} from spark_side except all from sql_side)"
    ).fetchall()[0][0]
    if extra:
        sample = con.sql(
            f"select * from (select {cols} from spark_side except all from sql_side) limit 3"
        ).fetchall()
        other = con.sql(
            f"select * from (from sql_side except all select {cols} from spark_side) limit 3"
        ).fetchall()
        problems.append(f"{extra} rows only in Spark, e.g. {sample}; only in SQL {other}")
    return problems
