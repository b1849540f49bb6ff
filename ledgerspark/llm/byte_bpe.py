"""Byte-level BPE with a segment tree of pair ranks, and decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import gather, map_slices, text_or_empty

NONE = np.int64(1) << 62
#: Words up to this many bytes are merged many at a time, longer ones one by one.
WIDE = 64
#: Entries of each kind that a worker keeps; a full cache starts anew.
CACHE = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class ByteBpe:
    """Encode and decode with fixed ranks.

    Over the byte positions of a word stands a segment tree of ``rank * width + position``
    for the pair that starts there, so its root is the leftmost pair of the lowest rank.
    A merge changes three leaves: the merged pair's, its predecessor's and the one that
    ended; each costs a walk to the root. ``encode_words`` holds words of like length as
    the rows of a matrix of trees and merges in all rows at once.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {i: token for token, i in ranks.items()}
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.base = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = rank
        self.pair_ranks = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_values = np.array([pairs[k] for k in sorted(pairs)], np.int64)
        self.words: dict[bytes, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_values[at], NONE)

    def encode_words(self, words: Iterable[bytes]) -> None:
        """Put the ids of words (little-endian unsigned 32-bit) into ``self.words``."""
        by_width: dict[int, list[bytes]] = {}
        for word in words:
            if word in self.ranks:
                self.words[word] = self.ranks[word].to_bytes(4, "little")
            elif len(word) > WIDE:
                self.words[word] = self._merge_one(word)
            else:
                by_width.setdefault(1 << (len(word) - 1).bit_length(), []).append(word)
        for width, group in by_width.items():
            for k in range(0, len(group), 1 << 15):
                self._merge_many(group[k : k + (1 << 15)], width)

    def _merge_many(self, words: list[bytes], width: int) -> None:
        n, size = len(words), np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
        ids = self.bytes[raw.reshape(n, width)]
        place = np.arange(width)
        # one place more than the width: number -1 and number width are the same spare
        follow = np.tile(np.append(place + 1, width), (n, 1))
        before = np.tile(np.append(place - 1, width), (n, 1))
        follow[np.arange(n), size - 1] = width
        tree = np.full((n, 2 * width), NONE)
        pair = self._rank(ids[:, :-1], ids[:, 1:])
        real = place[None, 1:] < size[:, None]
        tree[:, width : 2 * width - 1] = np.where(
            real & (pair < NONE), pair * width + place[:-1], NONE
        )
        for level in range(width.bit_length() - 1, 0, -1):
            low = 1 << (level - 1)
            below = tree[:, 2 * low : 4 * low]
            tree[:, low : 2 * low] = np.minimum(below[:, 0::2], below[:, 1::2])
        ids = np.hstack([ids, np.zeros((n, 1), np.int64)])
        live = np.flatnonzero(tree[:, 1] < NONE)
        while len(live):
            root = tree[live, 1]
            left = root % width
            right = follow[live, left]
            after, ahead = follow[live, right], before[live, left]
            ids[live, left] = root // width
            ids[live, right] = -1
            follow[live, left] = after
            before[live, after] = left
            self._set(tree, live, right, np.full(len(live), NONE), width)
            pair = self._rank(ids[live, left], ids[live, after])
            value = np.where((after < width) & (pair < NONE), pair * width + left, NONE)
            self._set(tree, live, left, value, width)
            has = ahead >= 0
            rows, ahead, at = live[has], ahead[has], left[has]
            pair = self._rank(ids[rows, ahead], ids[rows, at])
            self._set(tree, rows, ahead, np.where(pair < NONE, pair * width + ahead, NONE), width)
            live = live[tree[live, 1] < NONE]
        keep = (place < size[:, None]) & (ids[:, :width] >= 0)
        flat, ends = ids[:, :width][keep].astype("<u4"), keep.sum(1).cumsum()
        data, start = flat.tobytes(), 0
        for word, end in zip(words, (ends * 4).tolist(), strict=True):
            self.words[word] = data[start:end]
            start = end

    @staticmethod
    def _set(tree: np.ndarray, rows: np.ndarray, place: np.ndarray, value: np.ndarray, width: int):
        node = place + width
        tree[rows, node] = value
        while width > 1:
            node, width = node >> 1, width >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def _merge_one(self, word: bytes) -> bytes:
        """The same for a single long word, with plain lists."""
        n = len(word)
        width, none, base, ranks = 1 << (n - 1).bit_length(), int(NONE), self.base, self.pair_ranks
        ids = self.bytes[np.frombuffer(word, np.uint8)].tolist()
        follow, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * width)
        for k in range(n - 1):
            rank = ranks.get(ids[k] * base + ids[k + 1])
            if rank is not None:
                tree[width + k] = rank * width + k
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(place: int, value: int) -> None:
            node = place + width
            tree[node] = value
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    return
                tree[node] = low

        def pair(left: int) -> int:
            right = follow[left]
            rank = ranks.get(ids[left] * base + ids[right]) if right < n else None
            return none if rank is None else rank * width + left

        while tree[1] < none:
            rank, left = divmod(tree[1], width)
            right = follow[left]
            after = follow[right]
            ids[left], ids[right], follow[left] = rank, -1, after
            if after < n:
                before[after] = left
            put(right, none)
            put(left, pair(left))
            if before[left] >= 0:
                put(before[left], pair(before[left]))
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


class TextEncoder:
    """Encode whole texts; parts that recur are looked up.

    The pattern starts a new match at every space that is not within a longer run of white
    space. So texts are cut at their spaces, and of the distinct parts only those not met
    before are matched. A text in which white space stands on both sides of a cut is
    matched whole.
    """

    def __init__(self, bpe: ByteBpe, cache: int = CACHE):
        self.bpe, self.cache = bpe, cache
        self.parts: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text."""
        words, parts, find = self.bpe.words, self.parts, self.bpe.pattern.findall
        if len(words) > self.cache:
            words.clear()
        if len(parts) > self.cache:
            parts.clear()
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        distinct, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        heads, ends = bounds[:-1], bounds[1:]
        values = [parts.get(part) for part in distinct]
        new = {p: find(" " + p) for p, v in zip(distinct, values, strict=True) if v is None}
        opens = np.array([not p or p[0].isspace() for p in distinct], bool)[index]
        closes = np.array([not p or p[-1].isspace() for p in distinct], bool)[index]
        inside = np.append(closes[:-1] & opens[1:], False)
        inside[ends[:-1] - 1] = False  # between two texts
        runs = np.append(0, np.cumsum(inside))
        whole = np.flatnonzero(runs[ends] > runs[heads])
        first = [find(distinct[k]) for k in index[heads].tolist()]
        for k in whole.tolist():
            first[k] = find(texts[k].as_py())
        met = {w for found in chain(first, new.values()) for w in found}
        self.bpe.encode_words([b for w in met if (b := w.encode()) not in words])
        for part, found in new.items():
            parts[part] = b"".join([words[w.encode()] for w in found])
        values = [parts[p] if v is None else v for p, v in zip(distinct, values, strict=True)]
        values += [b"".join([words[w.encode()] for w in found]) for found in first]
        index = index.astype(np.int64)
        index[heads] = len(distinct) + np.arange(len(first))
        rest = gather(values, index, ends)
        for k, ids in enumerate(rest):
            yield ids if runs[ends[k]] == runs[heads[k]] else np.frombuffer(
                values[len(distinct) + k], "<u4"
            )


@lru_cache(maxsize=1)
def text_encoder(ranks_path: str, pattern: str) -> TextEncoder:
    """One per Python worker, so that later tasks find what earlier ones have met."""
    return TextEncoder(ByteBpe(read_ranks(ranks_path), pattern))


def encoded_batches(
    batches: Iterator[pa.RecordBatch], ranks_path: str, pattern: str
) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], ByteBpe]]:
    """Each batch with the ids of its column ``text``."""
    encoder = text_encoder(ranks_path, pattern)
    for batch in batches:
        yield batch, list(encoder.encode(batch["text"])), encoder.bpe


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Token ids of every text: key, ids array<int>; one row per input row.

    Each match of ``pattern`` is encoded separately, without special tokens. Null and empty
    texts give no ids. Nulls and repeats of the key are kept. ``ranks_path`` is read by every task,
    so it must exist on all machines.
    """
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, _ in encoded_batches(batches, ranks_path, pattern):
            ends = np.cumsum([0, *map(len, ids)])
            flat = pa.array(np.concatenate(ids).astype("i4"), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch["key"], lists], names=["key", "ids"])

    kind = rows.schema["key"].dataType.simpleString()
    return map_slices(rows, run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """Bytes of every row of ids: key, bytes binary; null ids give no bytes."""
    rows = encoded.select(F.col(key).alias("key"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = text_encoder(ranks_path, pattern).bpe
        for batch in batches:
            texts = [bpe.decode(np.array(x or [], "<u4")) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array(texts, pa.binary())], names=["key", "bytes"]
            )

    kind = rows.schema["key"].dataType.simpleString()
    return map_slices(rows, run, f"key {kind}, bytes binary").withColumnRenamed("key", key)


def round_trip_digests(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode, digest the ids, decode them and digest the bytes, in one pass.

    Returns key, n_tokens, ids_sha256, decoded_sha256. Ids stay within their task, because
    they take several times the space of the text.
    """
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, bpe in encoded_batches(batches, ranks_path, pattern):
            columns = {
                "key": batch["key"],
                "n_tokens": pa.array(list(map(len, ids)), pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                "decoded_sha256": pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]),
            }
            yield pa.RecordBatch.from_pydict(columns)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_slices(rows, run, schema).withColumnRenamed("key", key)
