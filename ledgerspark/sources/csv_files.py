"""Raw CSV files: union by column name, lines that do not fit set aside, source path kept."""

from __future__ import annotations

import logging
import posixpath
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.sources.csv_dialect import (
    QUOTES,
    Dialect,
    detect_dialects,
    ends_inside,
    field_count,
    first_lines,
    header_lines,
)
from ledgerspark.sources.manifest import COMPRESSED, list_files, plain_path
from ledgerspark.sources.tables import open_partitions

LOG = logging.getLogger(__name__)
SOURCE_PATH = "source_path"
PROBES = 16
_CORRUPT = "_rejected_line"
_KEEP_CORRUPT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}


def _options(dialect: Dialect, encoding: str = "UTF-8") -> dict[str, object]:
    # Quotes are escaped by doubling. Column pruning is off because with it a
    # count or a one-column select keeps malformed lines that collect() drops.
    return {
        "header": dialect.header is not None,
        "mode": "DROPMALFORMED",
        "columnPruning": False,
        "sep": dialect.sep,
        "quote": dialect.quote,
        "escape": dialect.quote,
        "encoding": encoding,
        "multiLine": dialect.breaks,
    }


def _quoted(name: str) -> str:
    return "`{}`".format(name.replace("`", "``"))


def _paths(spark: SparkSession, glob: str) -> list[str]:
    try:
        return sorted(r.path for r in list_files(spark, glob).select("path").collect())
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def unreadable_files(spark: SparkSession, paths: list[str], encoding: str = "UTF-8") -> dict[str, str]:
    """Error condition by path, for files that cannot be read to their end.

    A compressed file shows its damage only when all of it is read, so each of these is read
    once, in a job of its own. Plain files are opened together, and one by one if that fails.
    """
    suspects = [p for p in paths if p.lower().endswith(COMPRESSED)]
    plain = [p for p in paths if p not in suspects]
    try:
        if plain:
            header_lines(spark, plain, encoding)
    except (PySparkException, Py4JJavaError) as error:
        if not _read_error(error):
            raise
        suspects += plain

    def probe(path: str) -> str | None:
        try:
            spark.read.text(path).count()
        except (PySparkException, Py4JJavaError) as error:
            reason = _read_error(error)
            if not reason:
                raise
            return reason
        return None

    with ThreadPoolExecutor(PROBES) as pool:
        found = zip(suspects, pool.map(probe, suspects), strict=True)
        return {path: reason for path, reason in found if reason}


def _read_error(error: PySparkException | Py4JJavaError) -> str | None:
    """What kept Spark from reading a file; None if it failed for another reason."""
    if isinstance(error, PySparkException):
        condition = str(error.getCondition())
        return condition if condition.startswith("FAILED_READ_FILE") else None
    cause = error.java_exception
    while cause is not None:
        name = cause.getClass().getName()
        if name.startswith(("java.io.", "java.util.zip.")):
            return name
        cause = cause.getCause()
    return None


def empty_files(spark: SparkSession, glob: str) -> list[str]:
    """Files without any byte, which Spark's own listing leaves out."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [s.getPath().toString() for s in found or [] if s.isFile() and not s.getLen()]


def qualified_root(spark: SparkSession, root: str) -> str:
    """The folder as Spark names it, without ``.``, ``..`` and a trailing slash."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    text = path.getFileSystem(conf).makeQualified(path).toString()
    scheme, bare = re.match(r"^([a-zA-Z][\w+.-]*:(?://[^/]*)?)?(.*)$", text, re.DOTALL).groups()
    return (scheme or "") + posixpath.normpath(bare)


def relative_path(path: Column, root: str) -> Column:
    """The path under ``root``, a result of ``qualified_root``; part files count as one file.

    Spark reports absolute URIs, which differ between machines, while this path takes part
    in the ledger key. As many names are cut off as the root has, so the root may be a
    glob. A path that is not under a plain root fails the job. Decoding and patterns are only
    evaluated for the paths that need them, as this runs once per row.
    """
    bare = re.sub(r"^[a-zA-Z][\w+.-]*:(//[^/]*)?", "", root).rstrip("/")
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    full = F.when(path.contains("%"), decoded).otherwise(path)
    plain = F.regexp_replace(full, r"^[a-zA-Z][\w+.-]*:(//[^/]*)?", "")
    cut = F.substring_index(plain, "/", bare.count("/") + 1)
    under = F.substr(plain, F.length(cut) + 2)
    if not re.search(r"[*?\[{]", bare):
        outside = F.raise_error(F.concat(F.lit(f"not under {root}: "), path))
        under = F.when(F.startswith(plain, F.lit(bare + "/")), under).otherwise(outside)
    whole = F.regexp_replace(under, r"^(?:[^/=]+=)?(.+?\.csv)/part-[^/]+$", "$1")
    return F.when(under.contains("/part-"), whole).otherwise(under)


def source_name(path: str, root: str) -> str:
    """What ``relative_path`` gives for the decoded path of a file."""
    def bare(p: str) -> str:
        return re.sub(r"^[a-zA-Z][\w+.-]*:(//[^/]*)?", "", p).rstrip("/")

    below = bare(path).split("/")[bare(root).count("/") + 1 :]
    return re.sub(r"^(?:[^/=]+=)?(.+?\.csv)/part-[^/]+$", r"\1", "/".join(below))


def path_of_files(path: Column, root: str, files: list[str]) -> Column:
    """``relative_path`` for rows of ``files``, which are spelled as Spark reports them.

    Patterns cost more per row than reading it. Where the names of all files begin at one place, which
    is tried on every name here, rows are cut there and nothing else is evaluated.
    """
    bare = re.sub(r"^[a-zA-Z][\w+.-]*:(//[^/]*)?", "", root).rstrip("/")
    at = re.compile(rf"[a-zA-Z][\w+.-]*:(?://[^/]*)?{re.escape(bare)}/")
    simple = [f for f in files if re.fullmatch(r"[A-Za-z0-9_.:/=-]+", f) and at.match(f)]
    if len(simple) < len(files) or not files:
        return relative_path(path, root)
    names = {f: source_name(f, root) for f in files}
    start = files[0].find(names[files[0]], at.match(files[0]).end())
    if start > 0:
        cut = F.substr(path, F.lit(start + 1))
        if all(f[start:] == name for f, name in names.items()):
            return cut
        if all(f[start:].split("/")[0] == name for f, name in names.items()):
            return F.substring_index(cut, "/", 1)
    return relative_path(path, root)


@dataclass(frozen=True)
class CsvFiles:
    """Files that were looked at: dialect by path, and the files that hold blank lines only."""

    spark: SparkSession
    root: str
    encoding: str
    dialects: dict[str, Dialect]
    blank: list[str]

    def groups(self) -> dict[Dialect, list[str]]:
        """Spark maps columns by position, so only files of one dialect are read together."""
        out: dict[Dialect, list[str]] = {}
        for path, dialect in sorted(self.dialects.items()):
            out.setdefault(dialect, []).append(path)
        return out

    def rows(self, with_source: bool = True) -> DataFrame:
        """All records that fit their file's header, as text columns, matched by name."""
        parts = []
        for dialect, paths in self.groups().items():
            if dialect.unclosed:
                lines = self._lines(dialect, paths).where("fits").select(SOURCE_PATH, "fields.*")
                names = dict(zip(lines.columns[1:], [*dialect.columns, _CORRUPT], strict=True))
                part = lines.withColumnsRenamed(names).select(*map(_quoted, dialect.columns), SOURCE_PATH)
                part = part if with_source else part.drop(SOURCE_PATH)
            else:
                schema = T.StructType([T.StructField(c, T.StringType()) for c in dialect.columns])
                options = _options(dialect, self.encoding)
                part = self.spark.read.options(**options).schema(schema).csv(paths)
                if with_source:
                    part = part.select("*", self._source(paths).alias(SOURCE_PATH))
            parts.append(part)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def rejects(self) -> DataFrame:
        """The records that ``rows`` leaves out: source_path, line, reason."""
        parts = []
        for dialect, paths in self.groups().items():
            if dialect.unclosed:
                bad = self._lines(dialect, paths).where(~F.col("fits"))
            else:
                fields = [T.StructField(c, T.StringType()) for c in [*dialect.columns, _CORRUPT]]
                options = _options(dialect, self.encoding) | _KEEP_CORRUPT
                read = self.spark.read.options(**options).schema(T.StructType(fields))
                # Spark refuses to read the rejected line alone, so nothing of a column goes with it.
                nothing = F.coalesce(F.substring(F.col(_quoted(dialect.columns[0])), 1, 0), F.lit(""))
                line = F.concat(F.col(_CORRUPT), nothing).alias("line")
                bad = read.csv(paths).select(self._source(paths).alias(SOURCE_PATH), line)
                bad = bad.where(F.col("line").isNotNull())
            line = F.col("line")
            count = field_count(line, dialect.sep, dialect.quote).cast("string")
            count = F.concat(count, F.lit(f" of {dialect.width} fields"))
            left_open = ends_inside(line, dialect.sep, dialect.quote)
            reason = F.when(left_open, "quote left open").otherwise(count).alias("reason")
            parts.append(bad.select(SOURCE_PATH, "line", reason))
        return reduce(DataFrame.unionByName, parts)

    def _lines(self, dialect: Dialect, paths: list[str]) -> DataFrame:
        """Files with a quote that never closes, line by line: such a quote ends with its line.

        Returns source_path, line, fields, and whether the line fits: its quotes close, and it
        has as many fields as the header.
        """
        options = {"header": dialect.header is not None, "sep": "\u0001", "quote": "", "encoding": self.encoding}
        lines = self.spark.read.options(**options).schema("line string").csv(paths)
        schema = ", ".join(f"c{k} string" for k in range(dialect.width)) + f", {_CORRUPT} string"
        own = {"sep": dialect.sep, "quote": dialect.quote, "escape": dialect.quote} | _KEEP_CORRUPT
        lines = lines.select(self._source(paths).alias(SOURCE_PATH), "line", F.from_csv("line", schema, own).alias("fields"))
        closed = ~ends_inside(F.col("line"), dialect.sep, dialect.quote)
        return lines.select("*", (closed & F.col(f"fields.{_CORRUPT}").isNull()).alias("fits"))

    def _source(self, paths: list[str]) -> Column:
        return path_of_files(F.col("_metadata.file_path"), self.root, paths)


def look_at_csv(
    spark: SparkSession,
    root: str,
    pattern: str = "*.csv",
    multi_line: bool | None = None,
    sep: str | None = None,
    quote: str | None = None,
    encoding: str = "UTF-8",
    header: bool | None = None,
    paths: list[str] | None = None,
    required: list[str] | None = None,
) -> CsvFiles:
    """Find the files and their dialects.

    The first line that is not blank is the header, unless it looks like the lines after it; see
    ``detect_dialects`` for what None finds out. ``multi_line`` None looks for quoted line
    breaks in one pass over all lines and reads only the files that may have some as a whole;
    False trusts that there are none, True reads every file as a whole. A file in which a quote
    never closes is logged and read line by line. Files of blank lines only
    are logged and hold no rows; a file that cannot be read fails the job. ``paths`` looks at these
    files only. ValueError names the files whose header has none of ``required``.
    """
    root = qualified_root(spark, root)
    if paths is None:
        paths = _paths(spark, f"{root}/{pattern}")
    heads, marked = {}, None
    if paths and multi_line is None:
        heads, marked = first_lines(spark, paths, encoding, [quote] if quote else list(QUOTES))
    elif paths:
        heads = header_lines(spark, paths, encoding)
    if not heads:
        raise FileNotFoundError(f"no CSV file with a header matches {root}/{pattern}")
    seen = {plain_path(p) for p in heads}
    blank = sorted(p for p in paths if plain_path(p) not in seen)
    if blank:
        LOG.warning("%d of %d files hold blank lines only", len(blank), len(paths))
    dialects = detect_dialects(spark, heads, sep, quote, encoding, header, multi_line, marked)
    if damaged := sorted(p for p, d in dialects.items() if d.unclosed):
        LOG.warning("a quote never closes in %s", damaged)
    for path, dialect in dialects.items():
        if dialect.breaks and not dialect.unclosed and _left_open(heads[path], dialect.quote):
            dialects[path] = _with_whole_header(spark, path, dialect, encoding)
    wanted = {c.lower() for c in required or ()}
    strange = [p for p, d in dialects.items() if not wanted & {c.lower() for c in d.columns}]
    if required and strange:
        raise ValueError(f"no expected column in the header of {strange}")
    return CsvFiles(spark, root, encoding, dialects, blank)


def _left_open(line: str, quote: str) -> bool:
    return line.count(quote) % 2 == 1


def _with_whole_header(spark: SparkSession, path: str, dialect: Dialect, encoding: str) -> Dialect:
    """The dialect of a file whose header itself has a quoted line break; reads its first record."""
    options = _options(dialect, encoding) | {"header": False, "mode": "PERMISSIVE"}
    first = spark.read.options(**options).csv(path).head()
    names = tuple(name or "" for name in first)
    return replace(dialect, header=names, width=len(names))


def read_csv_by_name(
    spark: SparkSession, root: str, pattern: str = "*.csv", with_source: bool = True, **options: object
) -> DataFrame:
    """All matching files under ``root`` as text columns, matched by header name.

    NULL stands for columns that a file does not have. Repeated names of one header are numbered, and empty
    names or those of a file without header are ``column0``, ``column1`` and so on. Records with
    more or fewer fields than their header are left out; ``CsvFiles.rejects`` returns them.
    ``options`` are those of ``look_at_csv``.
    """
    return look_at_csv(spark, root, pattern, **options).rows(with_source)


def read_csv_rejects(spark: SparkSession, root: str, pattern: str = "*.csv", **options: object) -> DataFrame:
    """What ``read_csv_by_name`` leaves out: source_path, line, reason."""
    return look_at_csv(spark, root, pattern, **options).rejects()


def ledger_files(
    spark: SparkSession, root: str, columns: list[str], pattern: str = "ledger_fy*.csv", **options: object
) -> CsvFiles:
    """The files of a ledger, each with a header that has one of ``columns`` at least."""
    options = {"quote": '"', "header": True} | options
    return look_at_csv(spark, root, pattern, required=columns, **options)


def declared_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The declared raw columns plus ``source_path``; undeclared columns are left out."""
    present = {c.lower() for c in df.columns}
    return df.select(
        *[
            F.col(c).alias(c) if c.lower() in present else F.lit(None).cast("string").alias(c)
            for c in columns
        ],
        SOURCE_PATH,
    )


def read_ledger_csv(
    spark: SparkSession, root: str, columns: list[str], pattern: str = "ledger_fy*.csv", **options: object
) -> DataFrame:
    """``declared_columns`` of the rows of ``ledger_files``."""
    return declared_columns(ledger_files(spark, root, columns, pattern, **options).rows(), columns)


def load_summary(rows: DataFrame, rejects: DataFrame) -> DataFrame:
    """Records read and left out per file: source_path, rows, rejected."""
    both = rows.select(SOURCE_PATH, F.lit(0).alias("bad"))
    both = both.unionByName(rejects.select(SOURCE_PATH, F.lit(1).alias("bad")))
    return both.groupBy(SOURCE_PATH).agg(
        F.count_if(F.col("bad") == 0).alias("rows"), F.count_if(F.col("bad") == 1).alias("rejected")
    )


def merge_raw(
    spark: SparkSession, root: str, out: str, fmt: str = "parquet", **options: object
) -> tuple[DataFrame, DataFrame]:
    """Write every CSV under ``root`` as one table; returns it and the files left out.

    A file that cannot be read to its end contributes no row; it is listed as (path, reason), and so
    are files without a header. Raises FileNotFoundError when no file can be read. Columns stay text.
    ``options`` are those of ``look_at_csv``.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unknown output format {fmt}")
    encoding = str(options.get("encoding", "UTF-8"))
    glob = f"{qualified_root(spark, root)}/*.csv*"
    found = _paths(spark, glob)
    broken = unreadable_files(spark, found, encoding)
    good = [p for p in found if p not in broken]
    files = look_at_csv(spark, root, paths=good, **options)
    broken |= dict.fromkeys(files.blank, "BLANK")
    broken |= dict.fromkeys(empty_files(spark, glob), "EMPTY")
    df = files.rows(with_source=False)
    skipped = spark.createDataFrame(sorted(broken.items()), "path string, reason string")
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(out)
        return spark.read.schema(df.schema).parquet(out), skipped
    write_csv(df, out)
    breaks = any(d.breaks for d in files.dialects.values())
    written = _options(Dialect(",", '"', tuple(df.columns), len(df.columns), breaks))
    return spark.read.options(**written).schema(df.schema).csv(out), skipped


def write_csv(
    df: DataFrame, out: str, partition_by: list[str] | None = None, keep_others: bool = False,
    compression: str = "none",
) -> None:
    """CSV with a header, spaces kept and quotes doubled, as the readers expect.

    ``keep_others`` replaces only the partitions that ``df`` has rows of. A file that is
    written with ``compression`` is read by one task. Gzip packs at level 3, as its usual level 6 takes more
    than twice the time for a tenth of the size.
    """
    writer = df.write.mode("overwrite").options(
        **{"zlib.compress.level": "THREE"},
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        partitionOverwriteMode="dynamic" if keep_others else "static",
        compression=compression,
    )
    if not partition_by:
        writer.csv(out)
        return
    with open_partitions(df.sparkSession):
        writer.partitionBy(*partition_by).csv(out)
