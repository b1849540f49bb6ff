"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = "[\x20\x09-\x0d]+"


def repeated_strings(texts: list[str | None], length: int = 200) -> list[tuple[int, int, int, bytes]]:
    """bytes, removed, runs and what is left of each text."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        runs = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), runs, kept))
    return out


def shingles(text: str | None) -> frozenset:
    words = [w for w in re.split(SPACE, text or "") if w]
    width = min(5, len(words))
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1)) if words else frozenset()


def near_groups(docs: list[tuple[int, str | None]], similarity: float = 0.8) -> dict[int, tuple[int, int, int]]:
    """Smallest id of the group, links and copies of every id."""
    by_set = defaultdict(list)
    for i, text in docs:
        by_set[shingles(text)].append(i)
    sets = [s for s in by_set if s]
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for x, a in enumerate(sets):
        for y in range(x):
            common = len(a & sets[y])
            if common and common / (len(a) + len(sets[y]) - common) >= similarity:
                links[x] += 1
                links[y] += 1
                parent[root(x)] = root(y)
    members = defaultdict(list)
    for x, a in enumerate(sets):
        members[root(x)] += by_set[a]
    out = {i: (i, 0, 1) for i in by_set.get(frozenset(), [])}
    for x, a in enumerate(sets):
        for i in by_set[a]:
            out[i] = (min(members[root(x)]), links[x], len(by_set[a]))
    return out


def exact_groups(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    """Id that stays, group size and digest of every id."""
    groups = defaultdict(list)
    for i, text in docs:
        groups[re.sub(SPACE, "", text or "")].append((-len(text or ""), i))
    return {
        i: (min(group)[1], len(group), hashlib.sha256(body.encode()).hexdigest())
        for body, group in groups.items()
        for _, i in group
    }
