"""Packing documents into as few token sequences as possible by best fit."""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.shared import map_slices, stored, text_or_empty

CAPACITY = 4096
END_ID = 1
#: Pieces that a worker remembers, in two halves: the older one goes when the newer one is full.
CACHE = 500_000
#: Bytes of a text that are worked through at a time.
PART = 1 << 20

# How the tokenizer's file prepares texts, as far as it is done here.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

#: Characters whose lower case and kind are the same everywhere: ASCII and Latin up to U+017F.
LATIN = r"^[\x21-\x7e\x{a1}-\x{12f}\x{131}-\x{17f}]*$"
#: Stands before words for the whole tokenizer; no piece holds white space.
WHOLE = "\n"


def byte_letters() -> list[str]:
    """The letter by which byte-level tokenizers show each byte: itself if visible, else one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in visible else next(others)) for b in range(256)]


class Remembered:
    """Token ids of pieces, one after the other, and each piece's place."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])

    def add(self, piece: str, ids: Iterable[int]) -> int:
        place = self.place[piece] = len(self.place)
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        return place

    def at(self, place: int) -> array:
        return self.ids[self.ends[place] : self.ends[place + 1]]

    def joined(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``places`` in a row, and the end of each."""
        ids, ends = np.frombuffer(self.ids, np.uint32), np.frombuffer(self.ends, np.int64)
        return joined(ids, ends[places], ends[places + 1])


def joined(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values from each start to its end, all in a row, and where each one's end there."""
    sizes = ends - starts
    after = np.cumsum(sizes)
    total = int(after[-1]) if len(after) else 0
    return values[np.repeat(starts - (after - sizes), sizes) + np.arange(total)], after


class WordTokenizer:
    """Ids of whole texts through a tokenizer file whose normalizer and splitting are those above.

    No token crosses white space and words recur, so texts are split at ASCII white space, and the
    distinct words of a batch are made lower case and split as the file says. Each distinct piece is
    looked up once, and given to the tokenizer's model if it is new. Words with other
    characters than ``LATIN``, or with one of the file's own added tokens such as
    ``<|endoftext|>``, go to the whole tokenizer. A file that prepares texts in another way gets
    whole texts.
    """

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        file = json.loads(Path(path).read_text(encoding="utf-8"))
        self.known = file["normalizer"] == NORMALIZER and file["pre_tokenizer"] == PRE_TOKENIZER
        self.added = [t["content"] for t in file["added_tokens"]]
        self.letters = byte_letters()
        self.half = max(1, cache // 2)
        self.older, self.newer = Remembered(), Remembered()

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text. Texts longer than ``PART`` are worked through part by part."""
        if not self.known:
            for text in texts.to_pylist():
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
            return
        start = 0
        for at in np.flatnonzero(pc.binary_length(texts).to_numpy() > PART).tolist():
            yield from self._words(texts.slice(start, at - start))
            parts = _parts(texts[at].as_py())
            yield np.concatenate([ids for part in parts for ids in self._words(pa.array([part]))])
            start = at + 1
        yield from self._words(texts.slice(start))

    def _words(self, texts: pa.Array) -> Iterator[np.ndarray]:
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        pieces = self._pieces(coded.dictionary)
        ids, ends = self._ids(pieces.flatten().dictionary_encode())
        ends = np.append(0, ends)[pieces.offsets.to_numpy()]  # of each distinct word
        index = coded.indices.to_numpy()
        out, after = joined(ids, ends[:-1][index], ends[1:][index])
        last = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        bounds = np.append(0, after)[np.append(0, last)].tolist()
        return (out[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))

    def _pieces(self, words: pa.StringArray) -> pa.ListArray:
        """What each word is made of, for the model; or the word after ``WHOLE``."""
        plain = pc.match_substring_regex(words, LATIN)
        for token in self.added:
            plain = pc.and_not(plain, pc.match_substring(words, token))
        lower = pc.utf8_lower(words)
        mixed = pc.and_not(plain, pc.utf8_is_alpha(lower))  # others are one piece, or whole
        cut = pc.replace_substring_regex(lower.filter(mixed), SPLIT, r"\0 ")
        lower = pc.replace_with_mask(lower, mixed, pc.ascii_rtrim(cut, " "))
        whole = pc.binary_join_element_wise(WHOLE, words, "")
        return pc.split_pattern(pc.if_else(plain, lower, whole), " ")

    def _ids(self, coded: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and the end of each."""
        if len(self.newer.place) > self.half:
            self.older, self.newer = self.newer, Remembered()
        known, add = self.newer.place.get, self._add
        pieces = coded.dictionary.to_pylist()
        places = np.array([add(p) if (k := known(p)) is None else k for p in pieces], np.int64)
        return self.newer.joined(places[coded.indices.to_numpy()])

    def _add(self, piece: str) -> int:
        """Place of a piece that is new to the newer half."""
        old = self.older.place.get(piece)
        if old is not None:
            return self.newer.add(piece, self.older.at(old))
        if piece.startswith(WHOLE):
            return self.newer.add(piece, self.tokenizer.encode(piece[1:], add_special_tokens=False).ids)
        shown = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        return self.newer.add(piece, [t.id for t in self.tokenizer.model.tokenize(shown)] if piece else ())


def _parts(text: str) -> Iterator[str]:
    """The text in parts that end at white space."""
    start = 0
    while len(text) - start > PART:
        cut = max(text.rfind(c, start, start + PART) for c in " \n")
        if cut < 0:
            cut = min((at for c in " \n" if (at := text.find(c, start)) >= 0), default=len(text) - 1)
        yield text[start : cut + 1]
        start = cut + 1
    yield text[start:]


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so that later tasks find what earlier ones have met."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokenizer(path)


def tokenized_pieces(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """Every text as token ids and ``end_id``, cut every ``capacity`` ids, one row per piece.

    Returns key, piece int, start long, length long, ids_crc32 long, where ``start`` counts
    the document's ids before the piece. Null and empty texts give one piece that holds
    ``end_id`` only. Nulls and repeats of the key are kept.
    """
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            out = []
            for row, numbers in enumerate(tokenizer.encode(batch["text"])):
                ids = numbers.tobytes() + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    out.append((row, piece, at // 4, len(cut) // 4, zlib.crc32(cut)))
            of, *columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch["key"].take(pa.array(of, pa.int64())), pa.array(columns[0], pa.int32())]
                + [pa.array(c, pa.int64()) for c in columns[1:]],
                names=["key", "piece", "start", "length", "ids_crc32"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long"
    return map_slices(rows, run, schema).withColumnRenamed("key", key)


def best_fit_runs(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> pd.DataFrame:
    """Where the items of each length go: length, first, count, sequence, offset.

    Items ``first`` to ``first + count - 1`` of a length go to the sequences from
    ``sequence`` on, one to each, at ``offset``. Items of one length and sequences of one
    gap are kept as runs, so the work depends on ``capacity`` and not on the number of items.

    Each step is one sweep in bulk: all waiting items of the largest remaining length ask for
    their successor among the gaps, the smallest that is large enough. Items of higher rank
    take it first; the rest ask for the next larger gap, and last for new sequences. Then
    the gaps that were used are put back at their new size, and the sweep repeats until no item
    of that length fits or waits.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    open_gaps = 0  # bit g is set while there is a gap of size g
    out, opened = [], 0
    for length, count in sorted(zip(lengths.tolist(), counts.tolist(), strict=True), reverse=True):
        placed = 0
        while placed < count:
            used: list[tuple[int, int, int]] = []
            while placed < count and (fits := open_gaps >> length):
                gap = length + (fits & -fits).bit_length() - 1
                start, size = gaps[gap].pop()
                take = min(size, count - placed)
                if take < size:
                    gaps[gap].append((start + take, size - take))
                if not gaps[gap]:
                    open_gaps &= ~(1 << gap)
                used.append((gap, start, take))
                placed += take
            if not used:
                new = -(-(count - placed) // (capacity // length))
                used.append((capacity, opened, new))
                opened, placed = opened + new, placed + new
            first = placed - sum(take for _, _, take in used)
            for gap, start, take in used:
                out.append((length, first, take, start, capacity - gap))
                first += take
                if gap > length:
                    gaps.setdefault(gap - length, []).append((start, take))
                    open_gaps |= 1 << (gap - length)
    return pd.DataFrame(out, columns=["length", "first", "count", "sequence", "offset"], dtype="int64")


def best_fit(pieces: DataFrame, key: str, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id long and offset long to ``pieces`` (key, piece, length and others).

    Lengths run from 1 to ``capacity``. Pieces are range-sorted by length and written, so a hot
    length is spread over tasks. Ranks within a length come from the counts per (task, length),
    of which there are at most ``capacity`` plus the number of tasks. Only these counts reach
    the driver, which plans the runs; ``sequence`` and ``offset`` are then looked up in
    every task. Pieces of equal length are interchangeable, so ties change which
    document goes where and not the number of sequences. An empty table stays empty.
    """
    spark = pieces.sparkSession
    order = ["length", key, "piece"]
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = pieces.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id() % (1 << 33)  # Spark counts rows of a task from 0
    table = stored(ranged.select("*", F.spark_partition_id().alias("task"), row.alias("row")), "pieces")
    counts = table.groupBy("length", "task").agg(F.count("*").alias("n"), F.min("row").alias("row"))
    counts = counts.toPandas().sort_values(["length", "task"])
    total = counts.groupby("length")["n"].sum()
    runs = best_fit_runs(total.index.to_numpy(), total.to_numpy(), capacity)
    runs = runs.sort_values(["length", "first"])
    tasks, span = int(counts["task"].max()) + 1 if len(counts) else 1, int(total.sum()) + 1
    shared = spark.sparkContext.broadcast(
        {
            "at": (counts["length"] * tasks + counts["task"]).to_numpy(),
            "rank": (counts.groupby("length")["n"].cumsum() - counts["n"] - counts["row"]).to_numpy(),
            "run": (runs["length"] * span + runs["first"]).to_numpy(),
            "first": runs["first"].to_numpy(),
            "sequence": runs["sequence"].to_numpy(),
            "offset": runs["offset"].to_numpy(),
        }
    )

    columns = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            length, task, row = (batch[c].to_numpy().astype("i8") for c in ("length", "task", "row"))
            rank = row + plan["rank"][np.searchsorted(plan["at"], length * tasks + task)]
            at = np.searchsorted(plan["run"], length * span + rank, "right") - 1
            sequence = plan["sequence"][at] + rank - plan["first"][at]
            placed = [pa.array(sequence), pa.array(plan["offset"][at])]
            keep = [batch[c] for c in columns]
            names = [*columns, "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(keep + placed, names=names)

    new = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    schema = T.StructType([*pieces.schema.fields, *new])
    return map_slices(table, run, schema)


def pack_documents(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Tokenize, cut and pack: the columns of ``tokenized_pieces`` and ``best_fit``.

    The pieces are stored, because range-sorting reads them twice.
    """
    return best_fit(stored(tokenized_pieces(docs, path, key, text, capacity), "lengths"), key, capacity)
