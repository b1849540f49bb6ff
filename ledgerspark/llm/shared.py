"""Helpers of several operators: shared tables, word splitting, Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import ledgerspark
from ledgerspark.session import fresh_path
from ledgerspark.sources.tables import read_table


#: Tables written for the stage of a pipeline that runs now or ran last, oldest first.
_HELPERS: list[str] = []
_in_stage = False


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write below the shared checkpoint folder and read back, which cuts the lineage.

    The table survives the executors that wrote it. Results may read it lazily, so it
    stays until the folder is emptied after the run, or until ``stage`` deletes it.
    """
    path = fresh_path(df.sparkSession, f"llm-{name}")
    if _in_stage:
        _HELPERS.append(path)
    df.write.option("compression", compression).parquet(path)
    return read_table(df.sparkSession, path, df)


@contextmanager
def stage(docs: DataFrame) -> Iterator[None]:
    """Run one stage of a pipeline whose input is ``docs``.

    What earlier stages have stored is deleted first, except what ``docs`` still reads, as
    their results have been written by now. Collecting the driver's garbage lets Spark delete
    the shuffle files of their plans.
    """
    global _in_stage
    spark = docs.sparkSession
    needed = [unquote(f) for f in docs.inputFiles()] if _HELPERS else []
    for path in list(_HELPERS):
        if not any(f"{path.split(':', 1)[-1].lstrip('/')}/" in f for f in needed):
            delete_table(spark, path)
            _HELPERS.remove(path)
    spark.sparkContext._jvm.System.gc()
    _in_stage = True
    try:
        yield
    finally:
        _in_stage = False


def delete_table(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def without_spaces(c: Column) -> Column:
    """Delete every space, tab, line feed, vertical tab, form feed and return."""
    return F.regexp_replace(c, r"[\x20\x09-\x0D]+", "")


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``max_bytes``, or one row if that is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * min(1.0, max_bytes / max(1, batch.nbytes))))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application."""
    context, home = spark.sparkContext, Path(ledgerspark.__file__).parent
    if context.applicationId in _SHIPPED or not home.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="ledgerspark-code-")) / "ledgerspark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(home.rglob("*.py")):
            out.write(file, file.relative_to(home.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def map_slices(
    df: DataFrame,
    f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` over size-limited slices of the batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(slices(batches))
        pa.default_memory_pool().release_unused()

    ship_code(df.sparkSession)
    return df.mapInArrow(run, schema)


def gather(values: list[bytes], index: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """For each text, the 32-bit numbers of its words in a row.

    ``values`` holds the numbers of each distinct word as bytes, ``index`` the distinct word
    at each place, and ``ends`` the place after each text's last word.
    """
    flat = np.frombuffer(b"".join(values), "<u4")
    sizes = np.array([len(v) for v in values], np.int64) // 4
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[index]
    after = np.cumsum(lengths)
    out = flat[np.repeat(starts[index] - (after - lengths), lengths) + np.arange(lengths.sum())]
    bounds = np.append(0, after)[np.append(0, ends)]
    return (out[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
