"""Exact deduplication of a new batch against immutable snapshots behind fuse filters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import ship_code, stored, text_or_empty, without_spaces

#: Distinct digests in one filter, on average.
PER_FILTER = 200_000
#: Slots of a filter's segment (a power of two), and of room per digest.
SEGMENT, ROOM = 1 << 10, 1.25


class FuseFilter:
    """A static 3-wise binary fuse filter with 8-bit fingerprints.

    Every 64-bit key has one slot in each of three consecutive segments, and the xor of its slots
    is its fingerprint. All keys of the set are found; others with probability 1/256. The
    table is built by peeling: a key that is alone in some slot is set aside, which frees its
    other slots; the fingerprints are then filled in from the last key to the first. Keys that
    do not peel are tried again with the next seed and more room.
    """

    def __init__(self, seed: int, segments: int, table: np.ndarray):
        self.seed, self.segments, self.table = seed, segments, table

    @staticmethod
    def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
        x = keys.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))

    @classmethod
    def _slots(cls, keys: np.ndarray, seed: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        x = cls._mix(keys, seed)
        first = ((x >> np.uint64(34)) * np.uint64(segments)) >> np.uint64(30)
        inside = np.stack([x, x >> np.uint64(10), x >> np.uint64(20)]) & np.uint64(SEGMENT - 1)
        slots = (first + np.arange(3, dtype=np.uint64)[:, None]) * np.uint64(SEGMENT) + inside
        prints = cls._mix(x, 7) & np.uint64(255)
        return slots.astype(np.int64), prints.astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """From distinct keys."""
        for seed in range(1, 100):
            room = len(keys) * (ROOM + 0.05 * seed)
            segments = max(1, -int(-room // SEGMENT))
            slots, prints = cls._slots(keys, seed, segments)
            table = np.zeros((segments + 2) * SEGMENT, np.uint8)
            if cls._fill(table, slots, prints):
                return cls(seed, segments, table)
        raise ValueError("the keys are not distinct")

    @staticmethod
    def _fill(table: np.ndarray, slots: np.ndarray, prints: np.ndarray) -> bool:
        n = slots.shape[1]
        count = np.bincount(slots.ravel(), minlength=len(table))
        total = np.zeros(len(table), np.int64)  # sum of the key numbers in a slot
        np.add.at(total, slots.ravel(), np.tile(np.arange(n), 3))
        order, left, alone = [], n, np.flatnonzero(count == 1)
        while len(alone):
            key, at = np.unique(total[alone], return_index=True)
            order.append((key, alone[at]))
            left -= len(key)
            touched = slots[:, key].ravel()
            np.subtract.at(count, touched, 1)
            np.subtract.at(total, touched, np.tile(key, 3))
            touched = np.unique(touched)
            alone = touched[count[touched] == 1]
        if left:
            return False
        for key, own in reversed(order):
            table[own] = 0
            table[own] = prints[key] ^ np.bitwise_xor.reduce(table[slots[:, key]], axis=0)
        return True

    def has(self, keys: np.ndarray) -> np.ndarray:
        slots, prints = self._slots(keys, self.seed, self.segments)
        return np.bitwise_xor.reduce(self.table[slots], axis=0) == prints


def digests(docs: DataFrame, in_snapshot: Column, key: str, text: str, tie: str) -> DataFrame:
    """key, tie, in_snapshot, digest (of the text without white space), bits (60 of it), points, row."""
    body = text_or_empty(text)
    digest = F.unhex(F.sha2(without_spaces(body), 256))
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(tie).alias("tie"),
        F.coalesce(in_snapshot, F.lit(False)).alias("in_snapshot"),
        digest.alias("digest"),
        F.length(body).alias("points"),
        F.monotonically_increasing_id().alias("row"),
    )
    bits = F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long")
    return rows.withColumn("bits", bits)


def by_digest(rows: DataFrame) -> DataFrame:
    """One entry per digest: digest, bits, n, best. Pre-aggregated within tasks.

    The least ``best`` stays: most code points, then smallest tie, null last, then any one row.
    """
    none = F.col("tie").isNull().alias("none")
    best = F.struct((-F.col("points")).alias("minus"), none, "tie", "row", "key")
    return rows.groupBy("digest", "bits").agg(F.count("*").alias("n"), F.min(best).alias("best"))


def build_filters(entries: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of an immutable snapshot's entries: bucket, seed, segments, slots."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        filled = FuseFilter.build(group["bits"].unique())
        row = [group["bucket"].iloc[0], filled.seed, filled.segments, filled.table.tobytes()]
        return pd.DataFrame([row], columns=["bucket", "seed", "segments", "slots"])

    keys = entries.select((F.col("bits") % buckets).alias("bucket"), "bits")
    return keys.groupBy("bucket").applyInPandas(
        build, "bucket long, seed int, segments int, slots binary"
    )


def screen(entries: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Entries with ``maybe``: false if the snapshot surely lacks the digest.

    Each bucket meets its filter in one task; a bucket holds distinct digests, so no text is
    hot here. A bucket without a filter holds nothing.
    """

    def ask(group: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if own.empty or group.empty:
            return group[["digest"]].assign(maybe=False)
        row = own.iloc[0]
        table = np.frombuffer(row["slots"], np.uint8)
        found = FuseFilter(int(row["seed"]), int(row["segments"]), table)
        return group[["digest"]].assign(maybe=found.has(group["bits"].to_numpy()))

    keys = entries.select((F.col("bits") % buckets).alias("bucket"), "bits", "digest")
    asked = keys.groupBy("bucket").cogroup(filters.groupBy("bucket"))
    return asked.applyInPandas(ask, "digest binary, maybe boolean")


def checked_bytes(docs: DataFrame, positives: DataFrame, text: str) -> DataFrame:
    """Digests of the exact buckets in which all normalised texts are the same bytes.

    Only rows whose digest came out positive are compared, by least and greatest text within
    tasks first. Different texts with one SHA-256 stop the job.
    """
    body = without_spaces(text_or_empty(text))
    rows = docs.select(F.unhex(F.sha2(body, 256)).alias("digest"), body.alias("body"))
    met = rows.join(positives, "digest", "left_semi").groupBy("digest")
    same = met.agg(F.min("body").alias("low"), F.max("body").alias("high"))
    wrong = F.raise_error(F.lit("two texts have the same SHA-256"))
    return same.select(F.when(F.col("low") == F.col("high"), F.col("digest")).otherwise(wrong).alias("digest"))


def exact_dedup(
    docs: DataFrame, in_snapshot: Column, key: str = "doc_id", text: str = "text",
    tie: str | None = None, per_filter: int = PER_FILTER,
) -> DataFrame:
    """Group equal texts of a snapshot and a new batch, and choose the row that stays.

    ``in_snapshot`` tells the rows that are in the snapshot already; null counts as false.
    Texts are equal if identical without white space; null is empty, so all null, empty and
    blank texts are one group. The row with the most code points stays, then the one with the
    smallest ``tie`` (the key unless given), null last; of rows alike in both, one stays.

    The snapshot's digests get a binary fuse filter per bucket. The batch is grouped by
    digest on its own; digests that pass the filter join the snapshot's exact buckets, whose
    texts are compared byte by byte, and all others are new. Returns one row per document: key,
    keep_id, group_size, kept, text_sha256. Digests and counts move, texts only for the
    byte check, and copies are counted before they are shuffled.
    """
    ship_code(docs.sparkSession)
    rows = stored(digests(docs, in_snapshot, key, text, tie or key), "digests")
    old = stored(by_digest(rows.where("in_snapshot")), "snapshot")
    new = by_digest(rows.where(~F.col("in_snapshot")))
    buckets = max(1, -(-old.count() // per_filter))
    asked = stored(new.join(screen(new, build_filters(old, buckets), buckets), "digest"), "screened")
    positives = asked.where("maybe")
    exact = checked_bytes(docs, positives.select("digest"), text)
    stocked = old.select("digest", F.col("n").alias("old_n"), F.col("best").alias("old_best"))
    met = positives.join(exact, "digest").join(stocked, "digest", "left")
    merged = met.select(
        "digest",
        (F.col("n") + F.coalesce("old_n", F.lit(0))).alias("n"),
        F.least("best", "old_best").alias("best"),
    )
    groups = merged.unionByName(asked.where(~F.col("maybe")).select("digest", "n", "best"))
    groups = groups.unionByName(old.join(positives, "digest", "left_anti").select("digest", "n", "best"))
    return rows.join(groups, "digest").select(
        F.col("key").alias(key),
        F.col("best.key").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
