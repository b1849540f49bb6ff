"""File manifests: size and checksum per raw file, and what changed since the last."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_KEY = ["path", "length", "sha256"]
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")
ONE_FILE = str(1 << 40)
#: The byte-order mark of UTF-8.
MARK = b"\xef\xbb\xbf"


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """(path, length, modified) of matching files; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(glob)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def file_manifest(spark: SparkSession, glob: str) -> DataFrame:
    """(path, length, sha256, modified) per file; no file is held in memory.

    A task reads a file line by line and hashes its bytes as they come, so files of any size get the
    digest of the whole file. Spark would unpack files that are named as compressed ones; those are
    read as one value each, where above 2 GB Spark fails with its own error. Spark lists no empty
    files. One row per file reaches the driver, where Spark keeps its list of files as well.
    """
    files = list_files(spark, glob)
    packed = reduce(Column.__or__, [F.lower("path").endswith(F.lit(x)) for x in COMPRESSED])
    sizes = {r.path: r.length for r in files.where(~packed).collect()}
    found = _stream_digests(spark, sizes)
    streamed = spark.createDataFrame(sorted(found.items()), "path string, sha256 string")
    whole = spark.read.format("binaryFile").load(glob).where(packed | (F.col("length") <= len(MARK)))
    whole = whole.select("path", F.sha2("content", 256).alias("sha256"))
    digests = streamed.unionByName(whole).dropDuplicates(["path"])  # no lines in a mere mark
    return files.join(digests, "path").select("path", "length", "sha256", "modified")


def _stream_digests(spark: SparkSession, sizes: dict[str, int]) -> dict[str, str]:
    """SHA-256 of whole files, each read by one task.

    The line reader drops a byte-order mark and does not tell whether the last line ends with a line
    feed; the file's length says which of the four cases it was.
    """
    if not sizes:
        return {}

    def digest(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        path, count, plain, marked = None, 0, None, None
        out = []

        def close() -> None:
            if path is not None:
                last = [plain.copy(), marked.copy()]
                for h in last:
                    h.update(b"\n")
                shown = [h.hexdigest() for h in (plain, marked, *last)]
                out.append((path, count, *shown))

        for batch in batches:
            for at, line in zip(batch["path"].to_pylist(), batch["line"].to_pylist(), strict=True):
                if at != path:
                    close()
                    path, count = at, 0
                    plain, marked = hashlib.sha256(), hashlib.sha256(b"\xef\xbb\xbf")
                else:
                    plain.update(b"\n")
                    marked.update(b"\n")
                    count += 1
                plain.update(line)
                marked.update(line)
                count += len(line)
        close()
        names = ["path", "bytes", "plain", "marked", "plain_end", "marked_end"]
        columns = [list(c) for c in zip(*out, strict=True)] or [[]] * len(names)
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 4]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    own = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(name, ONE_FILE)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    lines = own.read.option("lineSep", "\n").text(sorted(sizes))
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("line"))
    schema = "path string, bytes long, plain string, marked string, plain_end string, marked_end string"
    by_plain = {plain_path(p): (p, n) for p, n in sizes.items()}
    out = {}
    for r in lines.mapInArrow(digest, schema).collect():
        path, length = by_plain[plain_path(unquote(r.path))]
        cases = {r.bytes: r.plain, r.bytes + 3: r.marked, r.bytes + 1: r.plain_end, r.bytes + 4: r.marked_end}
        if length not in cases:
            raise RuntimeError(f"{path} changed while it was read")
        out[path] = cases[length]
    return out


def plain_path(path: str) -> str:
    """One spelling for ``file:/x`` and ``file:///x``."""
    return re.sub(r"^([a-zA-Z][\w+.-]*:)/+", r"\1/", path)


def line_checksums(spark: SparkSession, glob: str) -> DataFrame:
    """(path, lines, line_sum) of text files; Spark splits large ones.

    ``line_sum`` adds up the 64-bit hashes of all lines, so it does not depend on their
    order. It is no sha256 and never stands in for one.
    """
    lines = spark.read.text(glob).select(F.col("_metadata.file_path").alias("path"), "value")
    total = F.sum(F.xxhash64("value").cast("decimal(20,0)"))
    return lines.groupBy("path").agg(F.count("*").alias("lines"), total.alias("line_sum"))


def changed_files(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Files that are new, or whose size or checksum differs from the last manifest."""
    return current.join(previous.select(*MANIFEST_KEY), MANIFEST_KEY, "left_anti")


def file_status(
    current: DataFrame, previous: DataFrame, expected: DataFrame | None = None
) -> DataFrame:
    """(path, status): new, changed, unchanged or removed; expected but absent is failed."""
    cur = current.select("path", F.struct("length", "sha256").alias("cur"))
    prev = previous.select("path", F.struct("length", "sha256").alias("prev"))
    both = cur.join(prev, "path", "full_outer")
    status = (
        F.when(F.col("prev").isNull(), "new")
        .when(F.col("cur").isNull(), "removed")
        .when(F.col("cur") == F.col("prev"), "unchanged")
        .otherwise("changed")
    )
    if expected is None:
        return both.select("path", status.alias("status"))
    wanted = expected.select("path").distinct().withColumn("wanted", F.lit(True))
    missing = F.col("wanted") & F.col("cur").isNull()
    return both.join(wanted, "path", "full_outer").select(
        "path", F.when(missing, "failed").otherwise(status).alias("status")
    )


def ingest_summary(status: DataFrame) -> DataFrame:
    """One row per status with its file count."""
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("files"))
