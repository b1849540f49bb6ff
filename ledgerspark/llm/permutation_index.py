"""Approximate nearest neighbours by inner product through a permutation index.

Every vector is represented by the order in which it sees the same few pivots, nearest
first. The index is a table of segments of up to 8,192 vectors. A segment holds its vectors
and one posting list for each pivot: the place of this pivot in the order of every vector. A
query reads the lists, adds up the footrule distance between its own places and those of each
vector, and scores the vectors of least distance on the original components.

Which rows take part: those with an id and a vector of the usual length (that of most rows)
whose components are all finite and not all zero. All others, null and empty vectors included,
are neither queries nor candidates. Rows with one id and several vectors are several rows.
Equal vectors share one representation; as they tie, a result needs no more than the
``top + 1`` least ids of each, so a vector that holds a third of all rows costs a few ids in
each segment. An empty table gives an empty result. Further columns are not read.

The footrule distance only chooses what is scored. Every row is indexed and measured against
every query, segment by segment, so the work grows with queries times rows, as that of an exact
search does; a query row meets each segment once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.shared import map_slices, stored

#: Pivots; a place among at most 256 fits a byte.
PIVOTS = 256
#: Vectors of a segment.
SEGMENT = 8192
#: What a segment scores for a query: this share of its vectors, and not less than FLOOR.
SHARE, FLOOR = 0.03, 128
MEMBER, POSTING, QUERY = 0, 1, 2
INDEX = "segment long, kind int, number long, data binary, ids array<long>"


def usual_size(df: DataFrame, vector: str = "embedding") -> int:
    """Number of components of most vectors that are not empty (the larger one of a tie)."""
    sizes = df.select(F.size(vector).alias("size")).where("size > 0").groupBy("size").count()
    usual = sizes.orderBy(F.desc("count"), F.desc("size")).select("size").head()
    return usual[0] if usual else 0


def component_type(df: DataFrame, vector: str = "embedding") -> str:
    """Vectors are kept as 32-bit floats if they are given so, otherwise as doubles."""
    return "<f4" if isinstance(df.schema[vector].dataType.elementType, T.FloatType) else "<f8"


def valid_vectors(df: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """Rows that take part: id long, v binary (little-endian components, minus zero made zero)."""
    dtype = component_type(df, vector)
    kind = {"<f4": "array<float>", "<f8": "array<double>"}[dtype]
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(kind).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & (F.size("v") == max(size, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["v"].flatten().to_numpy(zero_copy_only=False)  # null becomes NaN
            data = flat.astype(dtype).reshape(-1, size) + np.zeros(1, dtype)
            good = np.isfinite(data).all(axis=1) & (data != 0).any(axis=1)
            ids = batch["id"].filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([ids, _binary(data[good])], names=["id", "v"])

    return map_slices(rows, run, "id long, v binary")


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    width = rows.itemsize * rows.shape[1]
    ends = np.arange(len(rows) + 1, dtype="<i4") * width
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))]
    return pa.Array.from_buffers(pa.binary(), len(rows), buffers)


def _matrix(values: Iterable[bytes], dtype: str) -> np.ndarray:
    """Vectors as the rows of a matrix of doubles."""
    values = list(values)
    return np.frombuffer(b"".join(values), dtype).reshape(len(values), -1).astype("f8")


def choose_pivots(vectors: DataFrame, dtype: str, pivots: int = PIVOTS) -> tuple[np.ndarray, float]:
    """Distinct vectors of least hash, at most ``pivots`` of them, and the largest squared length.

    Each slice of rows hands on no more than its own ``pivots`` least, so repeats of a vector
    do not travel, and ``pivots`` rows reach the driver.
    """
    if not 1 <= pivots <= PIVOTS:
        raise ValueError(f"1 to {PIVOTS} pivots, as a place is one byte")
    hashed = vectors.select("v", F.xxhash64("v").alias("h"))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, first = np.unique(batch["h"].to_numpy(), return_index=True)
            longest = float(np.square(_matrix(batch["v"].to_pylist(), dtype)).sum(axis=1).max())
            some = batch.take(pa.array(first[:pivots]))
            yield some.append_column("longest", pa.array([longest] * some.num_rows))

    found = map_slices(hashed, least, "v binary, h long, longest double")
    found = stored(found.groupBy("h", "v").agg(F.max("longest").alias("longest")), "pivots")
    rows = found.orderBy("h", "v").limit(pivots).collect()
    if not rows:
        return np.zeros((0, 0)), 0.0
    longest = found.agg(F.max("longest")).head()[0]
    return _matrix((r.v for r in rows), dtype), longest


def places(data: np.ndarray, pivots: np.ndarray, longest: float | None) -> np.ndarray:
    """For each row of ``data`` the place of every pivot in its order, nearest pivot first.

    Vectors get a further component that makes all of them equally long, so that the nearest by
    distance is the largest inner product; a query (``longest`` is None) has none there.
    """
    near = data @ pivots.T
    if longest is not None:
        near += np.outer(_rest(data, longest), _rest(pivots, longest))
    order = np.argsort(-near, axis=1, kind="stable")
    out = np.empty(order.shape, np.uint8)
    np.put_along_axis(out, order, np.arange(len(pivots), dtype=np.uint8)[None, :], axis=1)
    return out


def _rest(data: np.ndarray, longest: float) -> np.ndarray:
    return np.sqrt(np.maximum(longest - np.square(data).sum(axis=1), 0.0))


def build_index(
    vectors: DataFrame, dtype: str, pivots: np.ndarray, longest: float, top: int,
    segment: int = SEGMENT,
) -> DataFrame:
    """The segments of ``valid_vectors`` as one table (``INDEX``), without a shuffle.

    Rows of kind MEMBER are the distinct vectors of a segment with their least ids, rows of kind
    POSTING the pivots' lists; entry i of a list belongs to member i. A segment is numbered by
    its task and its place there.
    """
    rows = vectors.select(F.spark_partition_id().alias("task"), "id", "v")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[bytes, list[int]] = {}
        count = 0
        for batch in batches:
            task = batch["task"][0].as_py()
            for key, v in zip(batch["id"].to_pylist(), batch["v"].to_pylist(), strict=True):
                ids = waiting.setdefault(v, [])
                ids.append(key)
                if len(ids) > 4 * top:
                    ids[:] = sorted(ids)[: top + 1]
                if len(waiting) == segment:
                    yield close((task << 32) + count, waiting)
                    waiting, count = {}, count + 1
        if waiting:
            yield close((task << 32) + count, waiting)

    def close(number: int, waiting: dict[bytes, list[int]]) -> pa.RecordBatch:
        lists = np.ascontiguousarray(places(_matrix(waiting, dtype), pivots, longest).T)
        n, m = len(waiting), len(lists)
        ids = [sorted(i)[: top + 1] for i in waiting.values()] + [None] * m
        columns = [
            pa.array([number] * (n + m), pa.int64()),
            pa.array([MEMBER] * n + [POSTING] * m, pa.int32()),
            pa.array([*range(n), *range(m)], pa.int64()),
            pa.array([*waiting, *map(bytes, lists)], pa.binary()),
            pa.array(ids, pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["segment", "kind", "number", "data", "ids"])

    return map_slices(rows, segments, INDEX)


def search_segments(
    index: DataFrame, queries: DataFrame, dtype: str, pivots: np.ndarray, top: int,
    share: float = SHARE, floor: int = FLOOR,
) -> DataFrame:
    """The best of every segment for every query: number long, id long, score double, own boolean.

    ``queries`` holds number long and v binary. A segment's rows go to one task, its members
    and lists first; then its queries stream past them, so a task holds one segment and one
    slice of queries. All vectors tied at the last distance are scored too. ``own`` marks
    vectors equal to the query.
    """
    segments = index.where((F.col("kind") == POSTING) & (F.col("number") == 0))
    numbers = segments.agg(F.collect_list("segment")).scalar()  # one for each 8,192 vectors
    asked = queries.select(
        F.explode(numbers).alias("segment"),
        F.lit(QUERY).alias("kind"),
        "number",
        F.col("v").alias("data"),
        F.lit(None).cast("array<long>").alias("ids"),
    )
    rows = index.unionByName(asked).repartition("segment")
    rows = rows.sortWithinPartitions("segment", "kind", "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, vectors, ids, lists, ready = None, [], [], [], None
        for batch in batches:
            number = batch["number"].to_pylist()
            data, out = batch["data"].to_pylist(), []
            kinds, keys = batch["kind"].to_pylist(), batch["segment"].to_pylist()
            found = batch["ids"].to_pylist()
            for i, (key, kind) in enumerate(zip(keys, kinds, strict=True)):
                if key != now:
                    now, vectors, ids, lists, ready = key, [], [], [], None
                if kind == MEMBER:
                    vectors.append(data[i])
                    ids.append(found[i])
                elif kind == POSTING:
                    lists.append(data[i])
                else:
                    ready = ready or Segment(vectors, ids, lists, dtype, pivots, top, share, floor)
                    out += [(number[i], *best) for best in ready.nearest(data[i])]
            if out:
                columns = zip(*out, strict=True)
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["number", "id", "score", "own"])

    return map_slices(rows, run, "number long, id long, score double, own boolean")


class Segment:
    """One segment in memory: its members and the pivots' posting lists."""

    def __init__(
        self, vectors: list[bytes], ids: list[list[int]], lists: list[bytes],
        dtype: str, pivots: np.ndarray, top: int, share: float, floor: int,
    ):
        self.keys, self.ids, self.pivots, self.top = vectors, ids, pivots, top
        self.dtype, self.vectors = dtype, _matrix(vectors, dtype)
        self.lists = np.frombuffer(b"".join(lists), np.uint8).reshape(len(lists), -1)
        self.scored = max(floor, top + 1, int(share * len(vectors)))

    def nearest(self, query: bytes) -> list[tuple[int, float, bool]]:
        """Up to ``top + 1`` of (id, score, own), best first."""
        q = _matrix([query], self.dtype)[0]
        chosen = self.chosen(q)
        scores = (self.vectors[chosen] * q).sum(axis=1)  # the same sum for a vector in any segment
        out: list[tuple[float, int, bool]] = []
        for at in np.argsort(-scores, kind="stable").tolist():
            if len(out) > self.top and -scores[at] > out[-1][0]:
                break
            row = int(chosen[at])
            own = self.keys[row] == query
            out += [(-float(scores[at]), i, own) for i in self.ids[row]]
            out = sorted(out)[: self.top + 1]
        return [(i, -score, own) for score, i, own in out]

    def chosen(self, q: np.ndarray) -> np.ndarray:
        """Members of least footrule distance.

        The distance of two whole orders, the sum of ``|a - b|`` over the pivots, is twice the sum
        of the larger places less a constant, so only the larger places are added up.
        """
        if self.scored >= len(self.ids):
            return np.arange(len(self.ids))
        own = places(q[None, :], self.pivots, None)[0]
        total = np.add.reduce(np.maximum(self.lists, own[:, None]), axis=0, dtype=np.uint16)
        return np.flatnonzero(total <= np.partition(total, self.scored - 1)[self.scored - 1])


def nearest_neighbours(
    df: DataFrame, every: int = 20, top: int = 20, key: str = "vec_id", vector: str = "embedding",
    pivots: int = PIVOTS, segment: int = SEGMENT, share: float = SHARE, floor: int = FLOOR,
) -> DataFrame:
    """The ``top`` nearest rows of every row whose id is divisible by ``every``.

    Returns query_id long, rank int, vec_id long, score double: the inner product in double
    precision, largest first, ties to the smaller id. A row is no neighbour of itself; with
    fewer rows than ``top`` all others are returned. Equal queries are searched once.
    """
    size, dtype = usual_size(df, vector), component_type(df, vector)
    vectors = valid_vectors(df, key, vector, size)
    chosen, longest = choose_pivots(vectors, dtype, pivots)
    index = stored(build_index(vectors, dtype, chosen, longest, top, segment), "permutation-index")
    asking = valid_vectors(df.where(F.col(key) % every == 0), key, vector, size)
    number = F.monotonically_increasing_id().alias("number")
    distinct = stored(asking.select("v").distinct().select(number, "v"), "queries")
    found = search_segments(index, distinct, dtype, chosen, top, share, floor)
    order = Window.partitionBy("number").orderBy(F.desc("score"), "id")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top + 1)
    best = best.groupBy("number").agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "score", "own"))).alias("best")
    )
    rows = asking.join(distinct, "v").select("number", F.col("id").alias("query_id"))
    rows = rows.join(stored(best, "best"), "number")
    itself = F.transform("best", lambda b: b["own"] & (b["id"] == F.col("query_id")))
    rows = rows.select("query_id", "best", F.array_position(itself, F.lit(True)).alias("itself"))
    rows = rows.select("query_id", "itself", F.inline("best"))
    after = (F.col("itself") > 0) & (F.col("place") > F.col("itself"))
    rows = rows.where(F.col("place") != F.col("itself"))
    rank = (F.col("place") - after.cast("int")).cast("int")
    rows = rows.select("query_id", rank.alias("rank"), F.col("id").alias("vec_id"), "score")
    return rows.where(F.col("rank") <= top)
