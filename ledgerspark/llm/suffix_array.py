"""Suffix arrays by induced sorting, in blocks of numpy operations."""

from __future__ import annotations

import numpy as np

#: Entries scanned at a time at most; and one by one where blocks would be shorter than SHORT.
BLOCK, SHORT, SINGLE = 1 << 15, 12, 256
#: Strings up to this length are sorted directly.
DIRECT = 24


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S); the last one, a sentinel, is S."""
    step = np.sign(np.diff(s))
    decided = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(decided[::-1])[::-1]
    return np.append(np.append(step, 1)[following] > 0, True)


def _scan(sa: np.ndarray, s: np.ndarray, wanted: np.ndarray, heads: np.ndarray, sign: int) -> None:
    """Induce predecessors of type ``wanted`` in one scan, upwards (sign 1) or downwards (-1).

    ``heads`` holds the next free place of each bucket. A scan reads a block at once and writes
    all its predecessors, as far as none of them falls into the block itself; there the block ends.
    """
    n, size = len(sa), SHORT * 4
    at = 0 if sign > 0 else n - 1
    while 0 <= at < n:
        block = sa[at : at + size] if sign > 0 else sa[max(0, at - size + 1) : at + 1][::-1]
        came = np.flatnonzero(block > 0)
        before = block[came] - 1
        right = wanted[before]
        came, before = came[right], before[right]
        length = len(block)
        if len(before):
            bucket = s[before]
            order = np.argsort(bucket, kind="stable")
            grouped = bucket[order]
            first = np.flatnonzero(np.append(True, grouped[1:] != grouped[:-1]))
            rank = np.arange(len(grouped)) - np.repeat(first, np.diff(np.append(first, len(grouped))))
            land = heads[grouped] + sign * rank
            ends = int(np.min(sign * (land - at)))
            if ends < length:
                length = ends
                if length < SHORT:
                    at = _scan_single(sa, s, wanted, heads, sign, at)
                    size = SHORT * 4
                    continue
                kept = came[order] < length
                order, grouped, land = order[kept], grouped[kept], land[kept]
            sa[land] = before[order]
            np.add.at(heads, grouped, sign)
        at += sign * length
        size = min(BLOCK, 2 * length)


def _scan_single(sa, s, wanted, heads, sign, at) -> int:
    for _ in range(SINGLE):
        if not 0 <= at < len(sa):
            break
        before = int(sa[at]) - 1
        if before >= 0 and wanted[before]:
            bucket = s[before]
            sa[heads[bucket]] = before
            heads[bucket] += sign
        at += sign
    return at


def _induce(s: np.ndarray, small: np.ndarray, leftmost: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones, sorted at least by first symbol."""
    sa = np.full(len(s), -1, np.int64)
    ends = np.cumsum(counts)
    bucket = s[leftmost]
    last = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True))
    own = np.diff(np.append(-1, last))
    rank = np.arange(len(bucket)) - np.repeat(last - own + 1, own)
    sa[ends[bucket] - np.repeat(own, own) + rank] = leftmost
    _scan(sa, s, ~small, ends - counts, 1)
    head = sa[0]
    _scan(sa, s, small, ends - 1, -1)
    sa[0] = head if head >= 0 else len(s) - 1
    return sa


def _same_substrings(s: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For neighbours in the list, whether s[start..end] is the same (first: False)."""
    sizes = ends - starts + 1
    same = np.append(False, sizes[1:] == sizes[:-1])
    pairs = np.flatnonzero(same)
    if len(pairs):
        width = sizes[pairs]
        offset = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        equal = s[np.repeat(starts[pairs], width) + offset] == s[np.repeat(starts[pairs - 1], width) + offset]
        same[pairs] = np.logical_and.reduceat(equal, np.cumsum(width) - width)
    return same


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order, for numbers from 0 whose last is the only 0.

    Suffixes are classified as larger or smaller than the next; the leftmost of each run of
    smaller ones are sorted by their substrings, which inducing from any order by first symbol
    does. Equal substrings get equal names, and where names repeat, the string of names is
    sorted in the same way. Their order then induces that of all suffixes.
    """
    n = len(s)
    if n <= DIRECT:
        items = s.tolist()
        return np.array(sorted(range(n), key=lambda i: items[i:]), np.int64)
    small = _types(s)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    counts = np.bincount(s)
    rough = _induce(s, small, leftmost[np.argsort(s[leftmost], kind="stable")], counts)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    ordered = rough[is_leftmost[rough]]
    number = np.searchsorted(leftmost, ordered)
    ends = np.append(leftmost[1:], n - 1)[number]
    names = np.cumsum(~_same_substrings(s, ordered, ends)) - 1
    if names[-1] + 1 < len(names):
        reduced = np.empty(len(names), np.int64)
        reduced[number] = names
        ordered = leftmost[suffix_array(reduced)]
    return _induce(s, small, ordered, counts)


def permuted_prefixes(data: bytes, sa: np.ndarray, room: np.ndarray, most: int) -> np.ndarray:
    """For every place, the common prefix with the suffix before it in order, in place order.

    ``room`` is the length that counts at each place; where it is below ``most``, here or
    there, the prefix is left 0. Others are compared eight bytes at a time up to ``most``, so
    a shorter prefix is given rounded down to a multiple of 8.
    """
    before = np.full(len(room), -1, np.int64)
    before[sa[1:]] = sa[:-1]
    words = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))
    common = np.zeros(len(room), np.int64)
    left = np.flatnonzero((before >= 0) & (room >= most) & (room[before] >= most))
    for k in [*range(0, most - 7, 8), most - 8]:
        left = left[words[left + k] == words[before[left] + k]]
        common[left] = k + 8
    return common
