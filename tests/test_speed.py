"""What keeps reading and staging of raw lines cheap, with the results of the plain way."""

from __future__ import annotations

import contextlib
import gzip
import io
import re

from pyspark.sql import functions as F

from ledgerspark.functions import surrogate_key
from ledgerspark.functions.cleaning import UNICODE_SPACES, trim_text
from ledgerspark.plans.staging import KEY_PARTS, RAW_COLUMNS, REQUIRED, SILVER_NAMES, UNTRIMMED, stage_ledger
from ledgerspark.sources import csv_dialect
from ledgerspark.sources.csv_dialect import first_lines, header_lines
from ledgerspark.sources.csv_files import look_at_csv, path_of_files, read_csv_by_name, relative_path, write_csv

NUMBERS = {"FISCAL_YEAR": "2024", "ACCOUNTING_PERIOD": "3", "POSTED_TOTAL_AMT": "1.50"}


def raw_lines(spark, *values):
    rows = [[NUMBERS.get(c, v) for c in RAW_COLUMNS] + ["a.csv"] for v in values]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in [*RAW_COLUMNS, "source_path"]))


def test_staging_is_one_method_that_java_compiles(spark, tmp_path):
    write_csv(raw_lines(spark, "x").drop("source_path"), str(tmp_path / "raw"))
    staged = stage_ledger(read_csv_by_name(spark, str(tmp_path / "raw")))
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        staged.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    assert len(sizes) == 1 and sizes[0] < 8000
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert "_metadata" not in plan or "regexp_replace" not in plan


def test_trimming_by_row_equals_trimming_by_value(spark):
    values = [" a ", "\u00a0z\u3000", f"{UNICODE_SPACES}b c{UNICODE_SPACES}", "\ta ", "é ", " \u2003 d\t\u00a0"]
    raw = raw_lines(spark, *values)
    staged = {r.row_id: r for r in stage_ledger(raw).collect()}
    plain = raw.select(trim_text(F.col("ROWID")).alias("t"), F.col("ROWID").alias("kept")).collect()
    assert len(staged) == len(values) == len({r.t for r in plain})
    texts = [c for c in RAW_COLUMNS if c not in NUMBERS]
    for r in plain:
        for c in texts:
            assert staged[r.t][SILVER_NAMES[c]] == (r.kept if c in UNTRIMMED else r.t)


def test_key_without_checks_of_required_columns(spark):
    raw = raw_lines(spark, "x").withColumn("PROJECT_ID", F.lit(None).cast("string"))
    staged = stage_ledger(raw)
    assert staged.where(F.col("ledger_sk") != surrogate_key(*KEY_PARTS)).count() == 0
    assert staged.where(F.col("ledger_sk") == surrogate_key(*KEY_PARTS, present=REQUIRED)).count() == 1


def test_paths_cut_at_one_place_equal_the_general_ones(spark):
    root = "file:/data/raw"
    cases = [
        [f"file:///data/raw/file=f{k}.csv/part-0{n}.csv.gz" for k in ("1", "22") for n in (1, 2)],
        ["file:///data/raw/a.csv", "file:///data/raw/fy23/long name.csv"],
        ["file:///data/raw/a.csv", "file:///data/raw/fy23/b.csv"],
        ["file:///data/raw/k=a.csv/part-1", "file:///data/raw/longer=b.csv/part-1"],
        ["file:///data/raw/x%20y.csv"], ["file:///data/raw/k=.csv/part-1", "file:///data/raw/k=b.csv/part-1"],
    ]
    for files in cases:
        df = spark.createDataFrame([(f.replace(" ", "%20"),) for f in files], "p string")
        both = df.select(path_of_files(F.col("p"), root, files).alias("a"), relative_path(F.col("p"), root).alias("b"))
        assert [r.a for r in both.collect()] == [r.b for r in both.collect()]
    cut = str(path_of_files(F.lit("x"), root, cases[0]))
    assert "regexp" not in cut and "regexp" in str(path_of_files(F.lit("x"), root, cases[3]))


def test_first_lines_need_no_task_per_file(spark, tmp_path, monkeypatch):
    texts = {"a.csv": "\n \nA,B\n1,2\n", "b.csv": "\ufeffA,B\n\"x\",2\n", "blank.csv": " \n\n", "c.csv": " A,B\n\"\",2\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    with gzip.open(tmp_path / "d.csv.gz", "wt") as f:
        f.write("A,B\n1,2\n" * 50)
    paths = [f"file://{p}" for p in sorted(tmp_path.iterdir())]
    heads, marked = first_lines(spark, paths, "UTF-8", ['"'])
    assert heads == header_lines(spark, paths) and len(heads) == 4
    assert [p.rsplit("/", 1)[1] for p in marked] == ["b.csv"]
    measured = []
    real = csv_dialect.measure
    monkeypatch.setattr(csv_dialect, "measure", lambda lines, *args: measured.append(lines) or real(lines, *args))
    files = look_at_csv(spark, str(tmp_path), "*.csv*", quote='"', header=True)
    assert len(files.dialects) == 4 and files.rows().count() == 1 + 1 + 1 + 99
    assert len(measured) == 1 and measured[0].inputFiles() == [p for p in paths if p.endswith("b.csv")]


def test_paired_quotes_never_end_inside(spark):
    """What lets files with empty quoted fields do without a second pass."""
    from itertools import product

    lines = ["".join(p) for n in range(1, 6) for p in product(['""', ",", "x"], repeat=n)]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert df.where(csv_dialect.ends_inside(F.col("line"), ",", '"')).count() == 0
    assert spark.range(1).where(csv_dialect.ends_inside(F.lit('x"y,"z'), ",", '"')).count() == 1
