"""Neighbours, filter audits and resampling on odd tables, against plain versions."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from hashlib import sha256
from itertools import permutations

import numpy as np
import pytest

from ledgerspark.llm import filter_audit, importance, permutation_index

VECTORS = "vec_id long, embedding array<float>, number int, id string, v string"
DOCS = "doc_id long, text string, lang string, n long, mask string, part string"
LABELS = "doc_id long, quality int, toxic int, n int"


def vector_rows(vectors):
    return [(i, None if v is None else [x if x is None else float(x) for x in v], 0, "", "") for i, v in vectors]


def plain_neighbours(vectors, every=20, top=20):
    """(query_id, rank, vec_id, score) by comparing everything."""
    good = []
    sizes = Counter(len(v) for _, v in vectors if v)
    usual = max(sizes, key=lambda n: (sizes[n], n), default=0)
    for i, v in vectors:
        if i is None or not v or len(v) != usual or None in v:
            continue
        v = np.array(v, "f4").astype("f8")
        if np.isfinite(v).all() and v.any():
            good.append((i, v))
    out = []
    for at, (i, q) in enumerate(good):
        if i % every == 0:
            near = sorted((-(v * q).sum(), j) for k, (j, v) in enumerate(good) if k != at)[:top]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(near, 1)]
    return sorted(out)


def neighbours(spark, vectors, **options):
    df = spark.createDataFrame(vector_rows(vectors), VECTORS)
    return sorted(map(tuple, permutation_index.nearest_neighbours(df, **options).collect()))


def test_vectors_that_take_no_part(spark):
    nan, inf = math.nan, math.inf
    vectors = [(0, [1, 0]), (20, [0, 1]), (1, None), (2, []), (3, [0, 0]), (4, [nan, 1]), (5, [inf, 1])]
    vectors += [(6, [None, 1]), (7, [1, 2, 3]), (None, [1, 1]), (40, None), (8, [-0.0, 2]), (9, [0.0, 2])]
    assert neighbours(spark, vectors) == plain_neighbours(vectors)
    assert neighbours(spark, [(1, None), (20, [])]) == neighbours(spark, []) == []
    assert neighbours(spark, [(20, [1, 2])]) == []


def test_repeated_vectors_and_ids(spark):
    # One vector holds a third of the rows, ids recur with the same and with other vectors.
    rng = np.random.default_rng(3)
    hot = [1.0, 2.0, -1.0]
    vectors = [(i, hot) for i in range(0, 300, 3)]
    vectors += [(i, rng.integers(-2, 3, 3).tolist()) for i in range(300) if i % 3]
    vectors += [(20, hot), (20, [2, 2, 2]), (20, [1, 1, 1]), (40, [5, 5, 5]), (40, [5, 5, 5])]
    assert neighbours(spark, vectors) == plain_neighbours(vectors)
    assert neighbours(spark, vectors, top=3, segment=50) == plain_neighbours(vectors, top=3)


@pytest.mark.parametrize("lengths", ["one", "many"])
def test_recall(spark, lengths):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(3000, 32))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    if lengths == "many":
        data *= rng.uniform(0.5, 2.0, size=(3000, 1))
    vectors = list(enumerate(data.astype("f4").tolist()))
    wanted = {(q, i): s for q, _, i, s in plain_neighbours(vectors)}
    got = neighbours(spark, vectors, segment=1000)
    assert Counter(q for q, *_ in got) == Counter(q for q, _ in wanted)
    found = [(q, i) for q, _, i, _ in got if (q, i) in wanted]
    assert len(found) >= 0.9 * len(wanted)
    assert all(s == pytest.approx(wanted[q, i], abs=1e-12) for q, _, i, s in got if (q, i) in wanted)


def test_places_are_footrule_orders():
    rng = np.random.default_rng(1)
    data, pivots = rng.normal(size=(40, 6)), rng.normal(size=(9, 6))
    longest = float(np.square(np.vstack([data, pivots])).sum(axis=1).max())
    full = np.hstack([data, np.sqrt(longest - np.square(data).sum(axis=1))[:, None]])
    own = np.hstack([pivots, np.sqrt(longest - np.square(pivots).sum(axis=1))[:, None]])
    distance = np.linalg.norm(full[:, None] - own[None], axis=2)
    places = permutation_index.places(data, pivots, longest)
    assert (places == distance.argsort(axis=1).argsort(axis=1)).all()


def plain_audit(docs, labels):
    def fails(i, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out = "A" if len(words) < 200 else ""
        out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        out += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
        out += "D" if re.search(r"[#$%&*|]", text) else ""
        smaller = any((t or "") == text and j is not None and j < i for j, t, _ in docs) if i is not None else False
        return out + ("E" if smaller else "")

    out = {}
    for part in {lang or "" for *_, lang in docs}:
        rows = [(i, fails(i, t or "")) for i, t, lang in docs if (lang or "") == part]
        good = {j for j, q, _ in labels if q == 1 and j is not None}
        toxic = {j for j, _, t in labels if t == 1 and j is not None}
        orders = ["".join(o) for o in permutations("ABCDE")]
        first = {o: [min((o.index(x) for x in f), default=5) for _, f in rows] for o in orders}
        shapley = Counter(o[k] for o in orders for k in first[o] if k < 5)
        for o in orders:
            for k, letter in enumerate(o):
                gone = [i for (i, _), at in zip(rows, first[o], strict=True) if at == k]
                kept = sum(at > k for at in first[o])
                late = sum(letter in f and at < k for (_, f), at in zip(rows, first[o], strict=True))
                only = sum(f == letter for _, f in rows)
                lost = (sum(i in good for i in gone), sum(i in toxic for i in gone))
                out[part, o, k + 1] = (kept, len(gone), late, only, *lost, shapley[letter])
    return out


def test_audit_of_odd_documents(spark):
    long = " ".join(f"w{i}" for i in range(250))
    docs = [(1, long, "en"), (2, long, None), (2, long, None), (3, long, "en"), (None, long, "en")]
    docs += [(4, "same " * 300, "en"), (5, None, "en"), (6, "", ""), (7, " \t\x0b\x0c\r\n ", "de")]
    docs += [(8, "A# " * 220, "de"), (9, long + " #", "de"), (10, long.upper(), "de"), (11, "é" * 40, "de")]
    docs += [(12, " x y " * 230, "de"), (1, "other", "fr"), (13, " lead and trail ", "fr")]
    docs += [(14, ("word%d " % 7) * 90_000, "fr"), (15, "É" + "x" * 40, "fr"), (16, "A" * 3 + "b" * 97, "fr")]
    labels = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (2, 1, None), (5, None, 1), (None, 1, 1), (99, 1, 1), (9, 1, 1)]
    rows = [(*d, 7, "x", "y") for d in docs]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    marks = spark.createDataFrame([(*x, 5) for x in labels], LABELS)
    got = filter_audit.filter_audit(df, marks).collect()
    assert len(got) == len({r[:3] for r in got})
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == plain_audit(docs, labels)


def test_audit_without_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert filter_audit.filter_audit(empty, spark.createDataFrame([], LABELS)).collect() == []


def test_lehmer_ranks():
    for rank, order in enumerate(permutations(range(5))):
        assert filter_audit.lehmer_rank(order, 5) == rank
    covered = Counter()
    for mask, _, first, after in filter_audit.removal_intervals(5):
        covered.update((mask, r) for r in range(first, after))
    assert set(covered.values()) == {1} and len(covered) == 31 * 120


def plain_words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_grams(text, low, high):
    words = plain_words(text)
    return [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


def plain_resample(docs, target, low, high, buckets, percent, least):
    def hashed(text):
        return [zlib.crc32(g.encode()) % buckets for g in plain_grams(text, low, high)]

    have, want = Counter(), Counter()
    for _, text in docs:
        have.update(hashed(text))
    for text in target:
        want.update(hashed(text))
    s, t = have.total(), want.total()
    rows = []
    for i, text in docs:
        gains = [
            math.floor(1000 * math.log((want[b] + 1) * (s + buckets) / ((have[b] + 1) * (t + buckets))))
            for b in hashed(text)
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(gains), weight, score, len(plain_words(text))))
    fits = sorted((-r[3], r[0] is None, r[0] or 0, r) for r in rows if r[4] >= least)
    ranks = Counter()
    for rank, (*_, r) in enumerate(fits[: percent * len(fits) // 100], 1):
        ranks[r, rank] += 1
    out = Counter((*r[:4], rank) for r, rank in ranks.elements())
    out.update((*r[:4], None) for r in (Counter(rows) - Counter(r for r, _ in ranks)).elements())
    return out


@pytest.mark.parametrize(("low", "high"), [(1, 1), (1, 3), (2, 2)])
def test_resample(spark, monkeypatch, low, high):
    monkeypatch.setattr(importance, "WORDS", 50)  # n-grams across the parts of a long text
    rng = np.random.default_rng(low + high)
    docs = [(i, " ".join(rng.choice(["Ab", "c9", "é", "x_y", "日本", "z"], 30))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, " .,-! "), (None, "a b c " * 20), (63, "a b c " * 20)]
    docs += [(64, "same Words twice " * 9)] * 5 + [(65, "x" * 3_000_000 + " y"), (66, "p q " * 300_000)]
    target = ["Ab c9 c9 z", None, "", "日本 é"]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, key int, score int")
    other = spark.createDataFrame([(t, "k") for t in target], "text string, key string")
    options = {"low": low, "high": high, "buckets": 97, "percent": 30, "least_words": 20}
    got = importance.resample(df.repartition(4), other, **options).collect()
    assert Counter(map(tuple, got)) == plain_resample(docs, target, low, high, 97, 30, 20)


def test_resample_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert importance.resample(empty, empty).collect() == []
    assert [tuple(r)[:3] for r in importance.resample(one, empty).collect()] == [(1, 2, -693)]


def test_shift_cancels_what_comes_before():
    rng = np.random.default_rng(2)
    texts = [rng.bytes(int(n)) for n in (0, 1, 7, 300, 70_001)]
    for a in texts:
        for b in texts:
            moved = importance.shift(np.array([zlib.crc32(a)]), np.array([len(b)]))
            assert int(moved[0]) ^ zlib.crc32(a + b) == zlib.crc32(b)
