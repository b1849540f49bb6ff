from __future__ import annotations

import gzip
import hashlib
import os
import random
import subprocess
import sys
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerspark.plans.staging import RAW_COLUMNS
from ledgerspark.sources import (
    changed_files,
    export_all,
    file_manifest,
    file_status,
    ingest_summary,
    line_checksums,
    load_summary,
    look_at_csv,
    materialize,
    merge_raw,
    read_csv_by_name,
    read_ledger_csv,
    read_targets,
    targets_frame,
)
from ledgerspark.sources.csv_dialect import walk

ROOT = Path(__file__).resolve().parent.parent


def test_malformed_lines_are_dropped_from_every_plan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B,C,D\n1,2,3,4\n1,2,3,4,5\n6,7\n5,6,7,8\n,,\"\",x\n")
    df = read_csv_by_name(spark, str(tmp_path))
    assert df.count() == len(df.collect()) == df.select("B").count() == 3
    last = df.where("D = 'x'").collect()[0]
    assert (last.A, last.B, last.C, last.source_path) == (None, None, None, "a.csv")


def test_quotes_spaces_and_unicode_names(spark, tmp_path):
    folder = tmp_path / "raw files"
    folder.mkdir()
    (folder / "é+1 %.csv").write_text('﻿A,B\n"x, ""y""", z \n')
    row = read_csv_by_name(spark, str(folder)).collect()[0]
    assert (row.A, row.B, row.source_path) == ('x, "y"', " z ", "é+1 %.csv")


def test_nested_folders_keep_their_path(spark, tmp_path):
    for year in ("fy22", "fy23"):
        (tmp_path / year).mkdir()
        (tmp_path / year / "ledger.csv").write_text("A\n1\n")
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        df = read_csv_by_name(spark, root, "fy*/*.csv")
        assert {r.source_path for r in df.collect()} == {"fy22/ledger.csv", "fy23/ledger.csv"}


def test_multi_line_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,B\n"x\ny",1\nz,2\n')
    rows = read_csv_by_name(spark, str(tmp_path), multi_line=True).collect()
    assert sorted((r.A, r.B) for r in rows) == [("x\ny", "1"), ("z", "2")]


def test_union_by_name(spark, tmp_path):
    (tmp_path / "one.csv").write_text("A,B,FISCAL,FUND\n1,2,2022,019000\n")
    (tmp_path / "two.csv").write_text("FUND,A,C\n021000,3,9\n")
    rows = {r.source_path: r for r in read_csv_by_name(spark, str(tmp_path)).collect()}
    one, two = rows["one.csv"], rows["two.csv"]
    assert (one.A, one.B, one.FISCAL, one.FUND, one.C) == ("1", "2", "2022", "019000", None)
    assert (two.A, two.B, two.FISCAL, two.FUND, two.C) == ("3", None, None, "021000", "9")


def test_ledger_columns_are_declared(spark, tmp_path):
    (tmp_path / "ledger_fy22_qtr1.csv").write_text("LEDGER,EXTRA,agencynbr\nACTUALS,e,090\n")
    (tmp_path / "other.csv").write_text("LEDGER\nBUDGET\n")
    df = read_ledger_csv(spark, str(tmp_path), RAW_COLUMNS)
    assert df.columns == [*RAW_COLUMNS, "source_path"]
    row = df.collect()[0]
    assert df.count() == 1
    assert (row.LEDGER, row.AGENCYNBR, row.ROWID) == ("ACTUALS", "090", None)
    assert row.source_path == "ledger_fy22_qtr1.csv"


def test_merge_raw(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with pytest.raises(FileNotFoundError):
        merge_raw(spark, str(raw), str(tmp_path / "none"))
    (raw / "a.csv").write_text("A,B\n1,2\n")
    (raw / "b.csv").write_text("B,C\n3,4\n5,6\n")
    (raw / "empty.csv").write_text("")
    for fmt in ("parquet", "csv"):
        merged, skipped = merge_raw(spark, str(raw), str(tmp_path / fmt), fmt)
        assert [r.path.split("/")[-1] for r in skipped.collect()] == ["empty.csv"]
        rows = sorted(map(tuple, merged.collect()), key=str)
        assert merged.columns == ["A", "B", "C"]
        assert rows == sorted([("1", "2", None), (None, "3", "4"), (None, "5", "6")], key=str)
    with pytest.raises(ValueError, match="json"):
        merge_raw(spark, str(raw), str(tmp_path / "x"), "json")


def test_manifest_and_changes(spark, tmp_path):
    for name, text in [("a.csv", "aaaa"), ("b.csv", "bbbb"), ("c.csv", "c")]:
        (tmp_path / name).write_text(text)
    pattern = f"{tmp_path}/*.csv"
    before = materialize(file_manifest(spark, pattern), f"{tmp_path}/m1")
    rows = {r.path.split("/")[-1]: r for r in before.collect()}
    assert rows["a.csv"].sha256 == hashlib.sha256(b"aaaa").hexdigest()
    assert rows["a.csv"].length == 4

    (tmp_path / "b.csv").write_text("BBBB")
    (tmp_path / "c.csv").unlink()
    (tmp_path / "d.csv").write_text("d")
    (tmp_path / "a.csv").write_text("aaaa")
    after = materialize(file_manifest(spark, pattern), f"{tmp_path}/m2")
    changed = {r.path.split("/")[-1] for r in changed_files(after, before).collect()}
    assert changed == {"b.csv", "d.csv"}

    root = rows["a.csv"].path.rsplit("/", 1)[0]
    names = ["a.csv", "c.csv", "e.csv"]
    expected = spark.createDataFrame([(f"{root}/{n}",) for n in names], "path string")
    status = {r.path.split("/")[-1]: r.status for r in file_status(after, before).collect()}
    assert status == {"a.csv": "unchanged", "b.csv": "changed", "c.csv": "removed", "d.csv": "new"}
    summary = ingest_summary(file_status(after, before, expected))
    counts = {r.status: r.files for r in summary.collect()}
    assert counts == {"unchanged": 1, "changed": 1, "new": 1, "failed": 2}


def test_manifest_of_odd_names(spark, tmp_path):
    for name in ("c%d.bin", "a b.bin", "é+.bin"):
        (tmp_path / name).write_bytes(name.encode())
    rows = {r.path.split("/")[-1]: r for r in file_manifest(spark, f"{tmp_path}/*.bin").collect()}
    assert {n: r.sha256 for n, r in rows.items()} == {
        n: hashlib.sha256(n.encode()).hexdigest() for n in ("c%d.bin", "a b.bin", "é+.bin")
    }


def test_line_checksums(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    (tmp_path / "b.txt").write_text("y\nx")
    (tmp_path / "c.txt").write_text("x\nz\n")
    a, b, c = sorted(line_checksums(spark, f"{tmp_path}/*.txt").collect())
    assert a.line_sum == b.line_sum != c.line_sum
    assert (a.lines, c.lines) == (2, 2)


def test_blank_first_line_and_separators(spark, tmp_path):
    (tmp_path / "one.csv").write_text("A,B\n1,2\n")
    (tmp_path / "two.csv").write_text(" \n\nA,B\n3,4\n")
    (tmp_path / "three.csv").write_text('A;"B,x"\n5;6\n')
    (tmp_path / "four.csv").write_text("B\tA\n8\t7\n")
    (tmp_path / "blank.csv").write_text("\n\n")
    rows = read_csv_by_name(spark, str(tmp_path)).collect()
    assert {(r.A, r.B, r["B,x"]) for r in rows} == {
        ("1", "2", None), ("3", "4", None), ("5", None, "6"), ("7", "8", None)
    }


def test_encoding_and_quote(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("A,B\né,'x,y'\n".encode("latin-1"))
    df = read_csv_by_name(spark, str(tmp_path), encoding="ISO-8859-1", quote="'")
    assert [(r.A, r.B) for r in df.collect()] == [("é", "x,y")]


def test_files_without_an_expected_column(spark, tmp_path):
    (tmp_path / "ledger_fy22_qtr1.csv").write_text("LEDGER\nACTUALS\n")
    (tmp_path / "ledger_fy22_qtr2.csv").write_text("SOMETHING\nx\n")
    with pytest.raises(ValueError, match="ledger_fy22_qtr2.csv"):
        read_ledger_csv(spark, str(tmp_path), RAW_COLUMNS)


def test_damaged_file_contributes_no_row(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    lines = "".join(f"{k},{k * 7919}\n" for k in range(100_000))
    whole = gzip.compress(("A,B\n" + lines).encode())
    (raw / "bad.csv.gz").write_bytes(whole[: len(whole) // 2])
    (raw / "good.csv").write_text("A,B\n1,2\n")
    merged, skipped = merge_raw(spark, str(raw), str(tmp_path / "out"))
    assert [tuple(r) for r in merged.collect()] == [("1", "2")]
    assert [r.path.split("/")[-1] for r in skipped.collect()] == ["bad.csv.gz"]
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_csv_by_name(spark, str(raw), "*.csv*").count()


def test_one_path_for_every_way_to_write_the_root(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "ledger_fy24_qtr1.csv").write_text("A\n1\n")
    monkeypatch.chdir(tmp_path)
    roots = [raw, f"{raw}/", f"{tmp_path}/x/../raw", f"{tmp_path}/./raw", f"file:{raw}", f"file://{raw}/",
             f"{tmp_path}/ra*"]
    for root in roots:
        rows = read_csv_by_name(spark, str(root)).collect()
        assert [r.source_path for r in rows] == ["ledger_fy24_qtr1.csv"], root


def test_changed_files_are_read_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A\n1\n")
    before = materialize(file_manifest(spark, f"{tmp_path}/*.csv"), f"{tmp_path}/m")
    (tmp_path / "b.csv").write_text("A\n2\n")
    new = changed_files(file_manifest(spark, f"{tmp_path}/*.csv"), before)
    df = read_csv_by_name(spark, str(tmp_path), paths=[r.path for r in new.collect()])
    assert [(r.A, r.source_path) for r in df.collect()] == [("2", "b.csv")]


def test_targets(spark, tmp_path):
    path = tmp_path / "targets.csv"
    path.write_text(
        "metric_name,fiscal_year,expected_value_usd\n"
        "total_revenue,2024,8500000000.50\ntotal_expenses,2024,-9200000000.75\n"
    )
    assert read_targets(spark, str(path)).collect() == targets_frame(spark).collect()


def test_export(spark, tmp_path):
    tables = {"a": spark.range(5), "b": spark.range(3).selectExpr("id", "cast(id as string) s")}
    paths = export_all(tables, str(tmp_path))
    assert {n: spark.read.parquet(p).count() for n, p in paths.items()} == {"a": 5, "b": 3}
    files = [f.name for f in (tmp_path / "b").iterdir() if f.name.endswith(".parquet")]
    assert all(".zstd." in f for f in files)


def rows_in(spark, folder, **options):
    files = look_at_csv(spark, str(folder), **options)
    return [r.asDict() for r in files.rows().collect()], [tuple(r) for r in files.rejects().collect()]


def test_quoted_line_breaks_are_found(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,B\n1,"x\r\n\n""y"", z"\n2,"w"\n')
    (tmp_path / "b.csv").write_text('A,B\n3,"p ""q"", r"\n4,5" pipe\n')
    (tmp_path / "c.csv").write_text('A,"B"\n5,5" pipe\n6,"5"" x\ny"\n"7\n","\n8,9\n"\n')
    files = look_at_csv(spark, str(tmp_path))
    assert [d.breaks for _, d in sorted(files.dialects.items())] == [True, False, True]
    rows, rejects = rows_in(spark, tmp_path)
    assert rejects == []
    assert sorted((r["A"], r["B"]) for r in rows) == [
        ("1", 'x\r\n\n"y", z'), ("2", "w"), ("3", 'p "q", r'), ("4", '5" pipe'),
        ("5", '5" pipe'), ("6", '5" x\ny'), ("7\n", "\n8,9\n"),
    ]
    df = read_csv_by_name(spark, str(tmp_path))
    assert df.count() == df.select("B").count() == 7


def test_clean_files_stay_splittable(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n" + "".join(f'{k},"v ""{k}"", w"\n' for k in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = read_csv_by_name(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 1 and df.count() == 20_000
        (tmp_path / "a.csv").write_text("A,B\n" + "".join(f'{k},"v\n{k}"\n' for k in range(20_000)))
        df = read_csv_by_name(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() == 1 and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rejects_and_reasons(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,B\n1,2\n1,2,3\n\n6\n"x,y",z,"u,\nv"\n')
    (tmp_path / "b.csv").write_text('A,B\n6,7"\n1,"never closed\n2,3\n4,5\n8,9,10\n')
    rows, rejects = rows_in(spark, tmp_path)
    assert sorted((r["A"], r["B"]) for r in rows) == [("1", "2"), ("2", "3"), ("4", "5"), ("6", '7"')]
    assert sorted(rejects) == [
        ("a.csv", '"x,y",z,"u,\nv"', "3 of 2 fields"),
        ("a.csv", "1,2,3", "3 of 2 fields"),
        ("a.csv", "6", "1 of 2 fields"),
        ("b.csv", '1,"never closed', "quote left open"),
        ("b.csv", "8,9,10", "3 of 2 fields"),
    ]
    files = look_at_csv(spark, str(tmp_path))
    summary = {tuple(r) for r in load_summary(files.rows(), files.rejects()).collect()}
    assert summary == {("a.csv", 1, 3), ("b.csv", 3, 2)}


def test_trusting_that_there_are_no_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,B\n1,"x\ny"\n')
    assert rows_in(spark, tmp_path, multi_line=True)[0][0]["B"] == "x\ny"
    assert not look_at_csv(spark, str(tmp_path), multi_line=False).dialects.popitem()[1].breaks


@pytest.mark.parametrize(
    ("text", "dialect", "first"),
    [
        ("A^B\n1^2\n", ("^", '"'), {"A": "1", "B": "2"}),
        ("A;B\n'x;y';2\n'z';3\n", (";", "'"), {"A": "x;y", "B": "2"}),
        ("A,B\n'tis,2\nO'Neil,3\n", (",", '"'), {"A": "'tis", "B": "2"}),
        ("A B~C-D\n1-2~3\nx~y-z\n", ("~", '"'), {"A B": "1-2", "C-D": "3"}),
        ("1\tx\n2\ty\n3\tz\n", ("\t", '"'), {"column0": "1", "column1": "x"}),
        ("k,2021,2022\na,1,2\nb,3,4\n", (",", '"'), {"column0": "k", "column1": "2021"}),
        ("id,2021,2022\n7,1,2\n8,3,4\n", (",", '"'), {"id": "7", "2021": "1"}),
        ("A,a,,A\n1,2,3,4\n", (",", '"'), {"A": "1", "a_1": "2", "column2": "3", "A_2": "4"}),
        ('"A\nB",C\n1,2\n', (",", '"'), {"A\nB": "1", "C": "2"}),
        ("one\nx\n", (",", '"'), {"one": "x"}),
    ],
)
def test_dialects(spark, tmp_path, text, dialect, first):
    (tmp_path / "a.csv").write_text(text)
    (found,) = look_at_csv(spark, str(tmp_path)).dialects.values()
    assert (found.sep, found.quote) == dialect
    rows, rejects = rows_in(spark, tmp_path)
    assert rejects == [] and first.items() <= rows[0].items()


LINES = ['1,"x', 'y",2', '"a""b"', 'p"q,r', '"",""', ',"', '"', "x,y", '"""', 'a,"b"c,"d']


@pytest.mark.parametrize("seed", range(4))
def test_walk_agrees_with_a_plain_reader(spark, seed):
    rng = random.Random(seed)
    lines = [*LINES, *("".join(rng.choices('",x ', k=rng.randint(1, 12))) for _ in range(200))]

    def plain(line, inside):
        place, seps = 2 if inside else 1, 0
        for c in line:
            if c == '"':
                place = {0: 0, 1: 2, 2: 3, 3: 2}[place]
            elif place != 2:
                place, seps = (1, seps + 1) if c == "," else (0, seps)
        return place == 2, seps

    df = spark.createDataFrame([(x,) for x in lines], "line string")
    for inside in (False, True):
        walked = walk(F.col("line"), ",", '"', inside)
        rows = df.select("line", (walked["place"] == 2).alias("open"), walked["seps"].alias("seps")).collect()
        assert [(r.open, r.seps) for r in rows] == [plain(r.line, inside) for r in rows]


def test_blank_files_in_one_look(spark, tmp_path):
    for k in range(6):
        (tmp_path / f"{k}.csv").write_text("A\n1\n" if k else " \n\n")
    merged, skipped = merge_raw(spark, str(tmp_path), str(tmp_path / "out"))
    assert merged.count() == 5
    assert [(r.path.split("/")[-1], r.reason) for r in skipped.collect()] == [("0.csv", "BLANK")]


def test_workers_need_no_package(tmp_path):
    (tmp_path / "a.csv").write_text('A,B\n1,"x\ny"\n')
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from ledgerspark.session import local_session
spark = local_session(2, **{{"spark.executorEnv.PYTHONPATH": ""}})
from ledgerspark.sources import read_csv_by_name
print("ROWS", [tuple(r) for r in read_csv_by_name(spark, {str(tmp_path)!r}).collect()])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "ROWS [('1', 'x\\ny', 'a.csv')]" in run.stdout, run.stderr[-2000:]


def test_digests_of_whole_files(spark, tmp_path):
    mark = b"\xef\xbb\xbf"
    texts = [b"a\nb\n", b"a\nb", b"\n", b"\n\n\n", mark + b"a\n", mark + b"a", mark + b"\n", mark, b"\x00\xff\n\r\n\r",
             b"x" * 200_000 + b"\ny", b"\r", b"l\n" * 30_000]
    for k, content in enumerate(texts):
        (tmp_path / f"{k} é.bin").write_bytes(content)
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress(b"a,b\n"))
    got = {Path(r.path).name: (r.length, r.sha256) for r in file_manifest(spark, f"{tmp_path}/*").collect()}
    files = {p.name: p.read_bytes() for p in tmp_path.iterdir()}
    assert got == {name: (len(c), hashlib.sha256(c).hexdigest()) for name, c in files.items()}
