"""Removal of long byte strings that occur more than once, by sharded suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import map_slices, slices, stored, text_or_empty
from ledgerspark.llm.suffix_array import permuted_prefixes, suffix_array

LENGTH = 200
#: Length of the substrings of a window, one of which names its shard.
GRAM = 64
#: Bytes of one suffix array, and distinct segments from which a shard is dealt out again.
SHARD_BYTES, HEAVY = 1 << 20, 4096
#: Multiplier of the rolling hash, and its inverse modulo 2 to the 64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes hashed at a time; a longer text is still taken whole.
SLICE = 1 << 20


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _least_in_window(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(x) - width + 1
    padded = np.append(x, np.full(-len(x) % width, np.iinfo(np.uint64).max, np.uint64))
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def segments_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Cut the windows of texts into segments: runs of windows with the same least gram hash.

    ``data`` holds the bytes of all texts and ``offsets`` their bounds. Returns text number, first
    window (its place in the text), number of windows, the hash (the segment's anchor), and whether
    the segment holds it more than once. Equal windows have equal anchors, wherever they are;
    two in one segment need two grams with that hash.
    """
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, bool))
    up, down = _powers(BASE, n + 1), _powers(INVERSE, n + 1)
    sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n]))
    hashes = (sums[gram:] - sums[: n - gram + 1]) * down[: n - gram + 1]
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    least = _least_in_window(hashes, length - gram + 1)
    inside = np.zeros(len(least) + 1, bool)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if end - start >= length:
            inside[start : end - length + 1] = True
    begins = np.flatnonzero(
        inside[:-1] & np.append(True, (least[1:] != least[:-1]) | ~inside[: len(least) - 1])
    )
    text = np.searchsorted(offsets, begins, "right") - 1
    # a run ends where the next begins, or with the last window of its text
    ends = np.minimum(np.append(begins[1:], n), offsets[text + 1] - length + 1)
    grams = ends - begins + length - gram
    offset = np.arange(grams.sum()) - np.repeat(np.cumsum(grams) - grams, grams)
    holds = hashes[np.repeat(begins, grams) + offset] == np.repeat(least[begins], grams)
    often = np.add.reduceat(holds, np.cumsum(grams) - grams, dtype=np.int64) > 1 if len(begins) else holds
    return text, begins - offsets[text], ends - begins, least[begins], often


def find_segments(rows: DataFrame, length: int) -> DataFrame:
    """Segments of all texts: part, start, windows, anchor, seg (hash of the segment's bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            texts = batch["text"].cast(pa.large_binary())
            ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
            offsets = ends - ends[0]
            text, start, windows, anchor, often = segments_of(data, offsets, length, GRAM)
            if not len(text):
                continue
            raw, first = memoryview(data), (offsets[text] + start).tolist()
            last = (offsets[text] + start + windows + length - 1).tolist()
            seg = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(first, last, strict=True)]
            columns = [
                batch["part"].take(pa.array(text)),
                pa.array(start.astype(np.int32)),
                pa.array(windows.astype(np.int32)),
                pa.array(anchor.view(np.int64)),
                pa.array(np.array(seg, np.uint64).view(np.int64)),
                pa.array(often),
            ]
            names = ["part", "start", "windows", "anchor", "seg", "often"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "part long, start int, windows int, anchor long, seg long, often boolean"
    return map_slices(rows.select("part", "text"), run, schema)


def repeated_windows(segments: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each segment, whether each of its windows starts elsewhere too.

    The segments, apart from each other, make one string; its suffixes are sorted, and a window
    repeats if the common prefix with the suffix before or after it is at least as long. All
    windows of a segment that occurs more than once repeat.
    """
    sizes = np.array([len(x) for x in segments])
    data = b"\0".join(segments) + b"\0"
    ends = np.cumsum(sizes + 1)
    text = np.frombuffer(data, np.uint8).astype(np.int64) + 2
    text[ends - 1] = 1
    text = np.append(text, 0)
    room = np.append(np.repeat(ends - 1, sizes + 1) - np.arange(len(data)), 0)
    order = suffix_array(text)
    common = permuted_prefixes(data + b"\0", order, room, length)
    same = common >= length
    before = order[np.flatnonzero(same[order]) - 1]
    same[before] = True
    starts = ends - 1 - sizes
    out = [same[a : a + size - length + 1] for a, size in zip(starts, sizes, strict=True)]
    return [np.ones_like(x) if c > 1 else x for x, c in zip(out, counts, strict=True)]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


SHARED = ["anchor", "seg"]
MARKS = "anchor long, seg long, spans array<struct<a:int,b:int>>"


def mark_shards(segments: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Spans of repeated windows of segments (anchor, seg, n, bytes): anchor, seg, spans.

    Anchors are dealt out by hash, and a task takes whole anchors in order, about
    ``shard_bytes`` at a time, into one suffix array.
    """
    dealt = segments.repartition("anchor").sortWithinPartitions(*SHARED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def done() -> pa.RecordBatch:
            counts = np.array([r[2] for r in rows])
            flags = repeated_windows([r[3] for r in rows], counts, length)
            spans = [[{"a": a, "b": b} for a, b in _runs(x)] for x in flags]
            kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], names=[*SHARED, "spans"])

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("anchor", "seg", "n", "bytes")), strict=True):
                if size > shard_bytes and row[0] != rows[-1][0]:
                    yield done()
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield done()

    return map_slices(dealt, run, MARKS)


def mark_windows(segments: DataFrame, length: int) -> DataFrame:
    """The same result for shards too large for one array: every window is dealt out by its hash.

    A window's 128-bit hash takes the place of its bytes; windows are counted within tasks
    first, so a window that all segments share is no bottleneck.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = memoryview(row["bytes"])
                n = len(raw) - length + 1
                hashes = [xxhash.xxh3_128_digest(raw[k : k + length]) for k in range(n)]
                columns = {
                    "anchor": pa.array([row["anchor"]] * n, pa.int64()),
                    "seg": pa.array([row["seg"]] * n, pa.int64()),
                    "a": pa.array(range(n), pa.int32()),
                    "n": pa.array([row["n"]] * n, pa.int64()),
                    "window": pa.array(hashes, pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    windows = map_slices(segments, run, "anchor long, seg long, a int, n long, window binary")
    often = windows.groupBy("window").agg(F.sum("n").alias("n")).where("n > 1").select("window")
    found = windows.drop("n").join(often, "window")
    span = F.struct("a", (F.col("a") + 1).alias("b"))
    return found.groupBy(*SHARED).agg(F.collect_list(span).alias("spans"))


def repeated_spans(
    rows: DataFrame, length: int, shard_bytes: int = SHARD_BYTES, heavy: int = HEAVY
) -> DataFrame:
    """part, spans: windows of each text (first, after last) that start elsewhere too.

    Texts are cut into segments, and only anchors that occur twice go on. If an anchor's segments
    are several and all the same, all their windows repeat; else its distinct segments are
    sorted in a shard. Segments are counted within tasks before they are shuffled, so a passage in a
    third of all texts is one row per task, and adaptive joins split its occurrences.
    """
    found = find_segments(rows, length)
    anchors = found.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("seg").alias("low"), F.max("seg").alias("high"),
        F.max("often").alias("often"),
    )
    same = (F.col("n") > 1) & (F.col("low") == F.col("high"))
    twice = anchors.where("n > 1 or often").select("anchor", same.alias("same"))
    shared = stored(found.drop("often").join(twice, "anchor"), "segments")
    span = F.struct(F.col("start").alias("a"), (F.col("start") + F.col("windows")).alias("b"))
    whole = shared.where("same").select("part", F.array(span).alias("spans"))
    mixed = shared.where("not same").drop("same")
    distinct = mixed.groupBy(*SHARED).agg(
        F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("part", "start", "windows"))
    )
    one = F.struct(*SHARED, "n", "start", "windows")
    wanted = distinct.groupBy("part").agg(F.collect_list(one).alias("cuts"))
    cut = rows.select("part", F.encode("text", "UTF-8").alias("data")).join(wanted, "part")
    own = F.substring("data", F.col("c.start") + 1, F.col("c.windows") + length - 1)
    cut = cut.select("data", F.explode("cuts").alias("c"))
    cut = cut.select("c.anchor", "c.seg", "c.n", own.alias("bytes"))
    cut = stored(cut, "shards")
    large = cut.groupBy("anchor").agg(F.count("*").alias("k"), F.sum(F.length("bytes")).alias("size"))
    large = large.where((F.col("k") > heavy) | (F.col("size") > 16 * shard_bytes)).select("anchor")
    marks = mark_shards(cut.join(large, "anchor", "left_anti"), length, shard_bytes)
    marks = marks.unionByName(mark_windows(cut.join(large, "anchor", "left_semi"), length))

    def in_text(x: Column) -> Column:
        return F.struct((x["a"] + F.col("start")).alias("a"), (x["b"] + F.col("start")).alias("b"))

    moved = mixed.join(marks, SHARED)
    moved = moved.select("part", F.transform("spans", in_text).alias("spans"))
    every = whole.unionByName(moved).groupBy("part")
    return every.agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _kept(data: bytes, spans: list | None, length: int) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left."""
    removed, runs, at, kept = 0, 0, 0, []
    end = -1
    for a, b in sorted((x["a"], x["b"] + length - 1) for x in spans or ()):
        if a >= b - length + 1:
            continue
        if a > end:
            runs += 1
            kept.append(data[at:a])
            removed += b - a
        elif b > end:
            removed += b - end
        end = at = max(end, b)
    return removed, runs, b"".join([*kept, data[at:]])


def remove_repeats(
    docs: DataFrame, carried: list[str], text: str = "text", length: int = LENGTH,
    as_text: bool = False, shard_bytes: int = SHARD_BYTES, heavy: int = HEAVY,
) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts elsewhere.

    Elsewhere is another place of the same or another text; overlaps count, and all strings are
    judged on the input. Texts are UTF-8 bytes, null is empty, and matches do not cross texts.
    Returns ``carried``, n_bytes, n_removed, n_spans (maximal removed runs) and kept (the remaining
    bytes; with ``as_text`` a string, without the characters that were cut); one row per input row. Repeated rows are
    repeated texts, so long ones lose everything. An empty table stays empty.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("part"),
        F.struct(*carried).alias("carried"),
        text_or_empty(text).alias("text"),
    )
    rows = stored(rows, "texts")
    spans = repeated_spans(rows.select("part", "text"), length, shard_bytes, heavy)
    both = rows.join(spans, "part", "left").drop("part")
    kind = rows.schema["carried"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, runs, kept = [], [], [], []
            for text, own in zip(batch["text"].cast(pa.binary()), batch["spans"].to_pylist(), strict=True):
                data = text.as_py()
                one = _kept(data, own, length)
                sizes.append(len(data))
                for column, value in zip((removed, runs, kept), one, strict=True):
                    column.append(value)
            if as_text:
                kept = [x.decode(errors="ignore") for x in kept]
            numbers = [pa.array(x, pa.int64()) for x in (sizes, removed, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch["carried"], *numbers, pa.array(kept, pa.string() if as_text else pa.binary())],
                names=["carried", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    out = map_slices(
        both, run,
        f"carried {kind}, n_bytes long, n_removed long, n_spans long, "
        f"kept {'string' if as_text else 'binary'}",
    )
    return out.select(*(F.col(f"carried.`{c}`").alias(c) for c in carried), "n_bytes", "n_removed", "n_spans", "kept")
