"""Resampling documents towards a target distribution of hashed word n-grams.

Words are runs of digits, letters a to z (A to Z made lower case) and characters above 127. The
words of a text, joined by one space, are scanned once; the running CRC-32 is kept at the ends
of every word. The CRC of an n-gram is that of the text up to its end, less the CRC up to its start
moved on by the n-gram's length: moving a CRC over zero bytes is linear over GF(2), so
the part before the n-gram cancels. No n-gram is ever built as a string.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import map_slices, stored, text_or_empty

BUCKETS = 10_000
SEED = 2024
#: Bytes of a text whose words are held at a time, and words whose n-grams are.
PART, WORDS = 1 << 20, 1 << 18
#: Lower case for A to Z; what is in no word becomes a space.
_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
NORMAL = bytes(c if c in _WORD else 32 for c in bytes(range(256)).lower())


def _zero_byte(crc: np.ndarray) -> np.ndarray:
    """CRCs moved on by one zero byte, without the inversions of CRC-32 at both ends."""
    for _ in range(8):
        crc = np.where(crc & 1, crc >> 1 ^ 0xEDB88320, crc >> 1)
    return crc


def _shift_tables(bits: int = 31) -> np.ndarray:
    """Tables [b, byte, value]: what a byte of a CRC becomes after 2**b zero bytes."""
    tables = np.empty((bits, 4, 256), np.uint32)
    values = np.arange(256, dtype=np.uint32)
    for byte in range(4):
        tables[0, byte] = _zero_byte(values << np.uint32(8 * byte))
    for b in range(1, bits):
        tables[b] = _moved(tables[b - 1], tables[b - 1])
    return tables


def _moved(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = table[0][crc & 255] ^ table[1][crc >> 8 & 255]
    return out ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


SHIFTS = _shift_tables()


def shift(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC moved on by as many zero bytes as ``lengths`` says, one power of two at a time."""
    out = crc.astype(np.uint32)
    for b in range(int(lengths.max(initial=0)).bit_length()):
        some = np.flatnonzero(lengths >> b & 1)
        out[some] = _moved(out[some], SHIFTS[b])
    return out


class PrefixCrcs:
    """CRCs of all n-grams of a row of texts, from the running CRCs of each text."""

    def __init__(self, low: int, high: int, buckets: int):
        self.low, self.high, self.buckets = low, high, buckets
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.lengths: list[int] = []
        self.of: list[tuple[int, int]] = []  # text and number of its words that wait
        self.out: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, text: int, data: memoryview) -> int:
        """Scan one text; returns its number of words."""
        crc = words = 0
        for part in _parts(data):
            found = part.split()
            for word in found:
                self.starts.append(crc)
                crc = zlib.crc32(word, crc)
                self.ends.append(crc)
                crc = zlib.crc32(b" ", crc)
            self.lengths.extend(map(len, found))
            self.of.append((text, len(found)))
            words += len(found)
            if len(self.starts) >= WORDS:
                self.flush(last=False)
        return words

    def flush(self, last: bool = True) -> None:
        """Derive what waits; unless it is the last, words that begin longer n-grams stay."""
        starts, ends = np.array(self.starts, np.uint32), np.array(self.ends, np.uint32)
        lengths = np.array(self.lengths, np.int64)
        texts, counts = np.array(self.of or [(0, 0)], np.int64).T
        of = np.repeat(texts, counts)
        after = np.cumsum(lengths + 1) - 1  # the words of all texts in a row
        before = after - lengths
        keep = 0 if last else min(self.high - 1, len(starts))
        first = len(starts) - keep  # n-grams that start before this word are complete
        for n in range(self.low, self.high + 1):
            size = max(0, min(first, len(starts) - n + 1))
            at = np.arange(size)
            at = at[of[at] == of[at + n - 1]]
            end = at + n - 1
            crc = ends[end] ^ shift(starts[at], after[end] - before[at])
            self.out.append((of[at], crc % np.uint32(self.buckets)))
        self.starts, self.ends = self.starts[first:], self.ends[first:]
        self.lengths = self.lengths[first:]
        self.of = [(int(t), 1) for t in of[first:]]

    def features(self, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all texts in a row, and the place after each text's last."""
        self.flush()
        of = np.concatenate([o for o, _ in self.out])
        buckets = np.concatenate([b for _, b in self.out])
        order = np.argsort(of, kind="stable")
        return buckets[order], np.cumsum(np.bincount(of, minlength=texts))


def _parts(data: memoryview) -> Iterator[bytes]:
    """The normalised text in parts that end at a space; a longer word stays whole."""
    left = b""
    for at in range(0, len(data), PART):
        part = bytes(data[at : at + PART]).translate(NORMAL)
        cut = part.rfind(b" ") + 1
        if cut:
            yield left + part[:cut]
            left = part[cut:]
        else:
            left += part
    yield left


def hashed_features(
    docs: DataFrame, key: str, text: str = "text", low: int = 1, high: int = 1, buckets: int = BUCKETS
) -> DataFrame:
    """Key, n_words long and the buckets (array<int>) of all runs of ``low`` to ``high`` words.

    A null text has no words. Nulls and repeats of the key are kept.
    """
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = PrefixCrcs(low, high, buckets)
            words = [crcs.add(i, memoryview(t.as_buffer())) for i, t in enumerate(batch["text"])]
            flat, ends = crcs.features(len(words))
            offsets = pa.array(np.append(0, ends).astype(np.int32))
            found = pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array(words, pa.int64()), found], names=["key", "n_words", "buckets"]
            )

    kind = rows.schema["key"].dataType.simpleString()
    out = map_slices(rows, run, f"key {kind}, n_words long, buckets array<int>")
    return out.withColumnRenamed("key", key)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket; a task sends one row for each bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            flat = batch["buckets"].flatten().to_numpy()
            total += np.bincount(flat, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = map_slices(features.select("buckets"), count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        out[row.bucket] = row.n
    return out


def bucket_gains(have: np.ndarray, want: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share of each bucket in the target over that in the input."""
    n, total_have, total_want = len(have), int(have.sum()), int(want.sum())
    return np.array(
        [
            math.floor(1000 * math.log(float((t + 1) * (total_have + n)) / float((s + 1) * (total_want + n))))
            for s, t in zip(have.tolist(), want.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(key: object, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, floored, from a digest of seed and key."""
    text = f"{seed}:{'' if key is None else key}"
    h = int(sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gains: np.ndarray, key: str, seed: int = SEED) -> DataFrame:
    """Key, n_words, n_features, weight and score (long).

    ``weight`` is the floored mean of the gains, 0 without features; ``score`` adds ``noise``.
    """
    shared = features.sparkSession.sparkContext.broadcast(gains)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch["buckets"]
            sums = np.append(0, np.cumsum(shared.value[found.flatten().to_numpy()]))
            ends = found.offsets.to_numpy() - found.offsets[0].as_py()
            n = np.diff(ends)
            weight = np.where(n > 0, np.diff(sums[ends]) // np.maximum(n, 1), 0)
            extra = np.array([noise(k, seed) for k in batch["key"].to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["n_words"], pa.array(n.astype(np.int64))]
                + [pa.array(weight), pa.array(weight + extra)],
                names=["key", "n_words", "n_features", "weight", "score"],
            )

    rows = features.select(F.col(key).alias("key"), "n_words", "buckets")
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_words long, n_features long, weight long, score long"
    return map_slices(rows, run, schema).withColumnRenamed("key", key)


def drawn(rows: DataFrame, key: str, percent: int = 10, least_words: int = 20) -> DataFrame:
    """Add rank long: 1, 2, 3 ... for the ``percent`` % of long enough rows with the highest scores.

    Rows are range-sorted with a number that sets equal rows apart, so that many rows of one key or
    score do not meet in one task. A row's rank is its place in its task plus the rows of the tasks
    before, of which one count each reaches the driver. Ties go to the smaller key, null keys last.
    """
    spark = rows.sparkSession
    fits = F.col("n_words") >= least_words
    rows = stored(rows.select("*", F.monotonically_increasing_id().alias("number")), "scores")
    order = [F.desc("fits"), F.desc("score"), F.asc_nulls_last(key), F.asc("number")]
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.withColumn("fits", fits).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id() % (1 << 33) + 1  # Spark counts rows of a task from 0
    ranged = stored(ranged.select("*", F.spark_partition_id().alias("task"), place.alias("place")), "ranked")
    counts = ranged.groupBy("task").agg(F.count_if("fits").alias("fits"), F.count("*").alias("n"))
    counts = sorted(counts.collect())
    draw = percent * sum(c.fits for c in counts) // 100
    before, offsets = 0, []
    for c in counts:
        offsets.append((c.task, before))
        before += c.n
    start = spark.createDataFrame(offsets, "task int, before long")
    ranked = ranged.join(F.broadcast(start), "task")  # a row per task
    rank = F.col("before") + F.col("place")
    rank = F.when(F.col("fits") & (rank <= draw), rank)
    return ranked.select(key, "n_features", "weight", "score", rank.alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", low: int = 1,
    high: int = 1, buckets: int = BUCKETS, percent: int = 10, least_words: int = 20, seed: int = SEED,
) -> DataFrame:
    """Every row of ``docs`` with its score, and the rank of those drawn.

    Returns key, n_features, weight, score, rank (long; rank null if not drawn). ``target`` has
    the same text column. Null and empty texts have no features and weight 0. Repeated rows
    count and are drawn each on its own. Texts are scanned once; their buckets are written.
    An empty target or an empty table of documents is allowed.
    """
    features = stored(hashed_features(docs, key, text, low, high, buckets), "features")
    wanted = hashed_features(target.select(F.lit(0).alias("key"), text), "key", text, low, high, buckets)
    gains = bucket_gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    return drawn(scored(features, gains, key, seed), key, percent, least_words)
