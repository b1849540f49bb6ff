"""Near-duplicate texts: MinHash bands for candidates, full shingle sets for the links."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import map_slices, ship_code, stored, text_or_empty

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.9999
#: Most MinHash functions; rows per band are as many as this allows.
HASHES = 224
SEED = 7
#: Sets compared at a time within a group; larger groups are dealt out in blocks of this size.
BLOCK = 2048
#: Members of a bucket that are compared by pairs; with more, within tasks.
FEW = 8


def bands_for(similarity: float, recall: float, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows per band: as many rows as fit while pairs at ``similarity`` reach ``recall``.

    A pair shares a band with probability s**rows, so it is missed by all with (1 - s**rows)**bands.
    """
    best = (hashes, 1)
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands * rows > hashes:
            break
        best = (bands, rows)
    return best


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of every run of ``words`` words; a shorter text is one run.

    Words are what stands between ASCII white space. A text without words has no shingles.
    """
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    distinct = [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()]
    hashes = np.append(np.array(distinct, np.uint64), np.uint64(0))[coded.indices.to_numpy()]
    real = np.array([bool(w) for w in coded.dictionary.to_pylist()], bool)[coded.indices.to_numpy()]
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = hashes[a:b][real[a:b]]
        width = max(1, min(words, len(own)))
        mixed = np.zeros(max(0, len(own) - width + 1), np.uint64)
        for k in range(width):
            mixed = (mixed ^ own[k : k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        out.append(np.unique(mixed))
    return out


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of every set's MinHash signature."""
    rng = np.random.default_rng(SEED)
    factors = rng.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, bands * rows, np.uint64)
    out = np.empty((len(sets), bands), np.uint64)
    for k, own in enumerate(sets):
        least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(own), 2048):  # long texts in pieces
            mixed = (own[at : at + 2048, None] ^ shifts) * factors
            np.minimum(least, mixed.min(0), out=least)
        band = np.arange(bands, dtype=np.uint64)
        for row in least.reshape(bands, rows).T:
            band = (band ^ row) * np.uint64(0x9E3779B97F4A7C15)
            band ^= band >> np.uint64(31)
        out[k] = band
    return out


def signatures(rows: DataFrame, bands: int, rows_each: int) -> DataFrame:
    """row, key, tie, cls (hash of the shingle set), size, bands; texts without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch["text"])
            kept = [k for k, own in enumerate(sets) if len(own)]
            sets = [sets[k] for k in kept]
            if not sets:
                continue
            flat = pa.array(band_hashes(sets, bands, rows_each).ravel().view(np.int64))
            ends = np.arange(len(sets) + 1, dtype=np.int32) * bands
            columns = [batch[c].take(pa.array(kept)) for c in ("row", "key", "tie")]
            columns.append(pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()))
            columns.append(pa.array([len(s) for s in sets], pa.int64()))
            columns.append(pa.ListArray.from_arrays(ends, flat))
            names = ["row", "key", "tie", "cls", "size", "bands"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    key, tie = (rows.schema[c].dataType.simpleString() for c in ("key", "tie"))
    schema = f"row long, key {key}, tie {tie}, cls binary, size long, bands array<long>"
    return map_slices(rows, run, schema)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def similar(common, total, similarity: float):
    """Jaccard of at least ``similarity`` from the overlap and the sum of both sizes."""
    return common * (1 + similarity) >= similarity * total - 1e-9


def verified(edges: DataFrame, texts: DataFrame, similarity: float, block: int) -> DataFrame:
    """The (a, b) of ``edges`` whose full shingle sets are similar; ``texts`` has c and text.

    All partners of ``a`` pass its set in a stream; if they are many, they are dealt out and ``a``
    goes to each part.
    """
    parts = edges.groupBy("a").agg(F.ceil(F.count("*") / block).alias("parts"))
    b_texts = texts.select(F.col("c").alias("b"), "text")
    a_texts = texts.select(F.col("c").alias("a"), "text")
    part = F.pmod(F.xxhash64("b"), F.col("parts")).alias("part")
    others = edges.join(parts, "a").select("a", part, "b").join(b_texts, "b")
    leads = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    leads = leads.join(a_texts, "a").withColumn("b", F.lit(None).cast("long"))
    both = leads.unionByName(others).repartition("a", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = None
        for batch in batches:
            found = []
            pairs = zip(*(batch[c].to_pylist() for c in ("a", "b")), strict=True)
            for (a, b), own in zip(pairs, shingle_sets(batch["text"]), strict=True):
                if b is None:
                    lead = own
                elif similar(min(len(own), len(lead)), len(own) + len(lead), similarity) and similar(
                    overlap(own, lead), len(own) + len(lead), similarity
                ):
                    found.append((a, b))
            if found:
                columns = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    ordered = both.sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return map_slices(ordered.select("a", "b", "text"), run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, group: the smallest node that each node of ``edges`` (a, b) is connected with.

    Every round takes the least group among neighbours and then the group's own group, so long
    chains shorten by half. Rounds are stored; only a count reaches the driver.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), "edges")
    first = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("group"))
    groups = stored(first.select(F.col("a").alias("node"), "group"), "groups")
    while True:
        near = both.join(groups, both["b"] == groups["node"]).groupBy("a").agg(F.min("group").alias("near"))
        least = groups.join(near, groups["node"] == near["a"])
        least = least.select("node", F.col("group").alias("old"), F.least("group", "near").alias("group"))
        least = stored(least, "groups")
        up = least.select(F.col("node").alias("group"), F.col("group").alias("top"))
        moved = (F.col("top") != F.col("old")).alias("moved")
        new = least.join(up, "group").select("node", F.col("top").alias("group"), moved)
        new = stored(new, "groups")
        groups = new.drop("moved")
        if not new.where("moved").count():
            return groups


def linked_matrix(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which sets are similar to which, none to itself.

    Shingles that many sets hold are multiplied as columns of a 0/1 matrix, a few thousand
    at a time; pairs that share a rare shingle are counted one by one.
    """
    m, sizes = len(sets), np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    held = np.diff(np.append(starts, len(values)))
    number = np.repeat(np.arange(len(starts)), held)
    common = np.zeros((m, m), np.float32)
    many = held > 64
    place, real = (np.cumsum(many) - 1)[number], many[number]
    for low in range(0, int(many.sum()), 2048):
        own = real & (place >= low) & (place < low + 2048)
        matrix = np.zeros((m, 2048), np.float32)
        matrix[owner[own], place[own] - low] = 1
        common += matrix @ matrix.T
    values, owner = number[~real], owner[~real]
    for step in range(1, 64):
        same = values[step:] == values[:-step]
        if not same.any():
            break
        x, y = owner[:-step][same], owner[step:][same]
        np.add.at(common, (x, y), 1)
        np.add.at(common, (y, x), 1)
    linked = similar(common.astype(np.float64), sizes[:, None] + sizes[None, :], similarity)
    np.fill_diagonal(linked, False)
    return linked


def _between_blocks(table: pa.Table, linked: np.ndarray) -> np.ndarray:
    """Only pairs of different blocks, if the task was given two."""
    if table["i"][0].as_py() != table["j"][0].as_py():
        block = table["block"].to_numpy()
        linked &= block[:, None] != block[None, :]
    return linked


def _sets_of(table: pa.Table) -> list[np.ndarray]:
    return shingle_sets(table["text"].combine_chunks())


def count_links(table: pa.Table, similarity: float) -> pa.Table:
    """Links of every set in one group, or between two blocks of a large group."""
    linked = _between_blocks(table, linked_matrix(_sets_of(table), similarity))
    return pa.table({"c": table["c"], "n_links": pa.array(linked.sum(1), pa.int64())})


def join_groups(table: pa.Table, similarity: float) -> pa.Table:
    """Pairs of groups (a, b) that a link connects, as few as connect them all."""
    linked = _between_blocks(table, linked_matrix(_sets_of(table), similarity))
    group = table["group"].to_numpy()
    x, y = np.nonzero(linked)
    pairs = np.unique(np.stack([group[x], group[y]], 1)[group[x] < group[y]], axis=0)
    parent: dict[int, int] = {}

    def root(g: int) -> int:
        while parent.setdefault(g, g) != g:
            g = parent[g] = parent[parent[g]]
        return g

    found = []
    for a, b in pairs.tolist():
        if root(a) != root(b):
            parent[root(b)] = root(a)
            found.append((a, b))
    columns = list(zip(*found, strict=True)) or [(), ()]
    return pa.table({"a": pa.array(columns[0], pa.int64()), "b": pa.array(columns[1], pa.int64())})


def in_blocks(rows: DataFrame, key: str, counted: DataFrame) -> DataFrame:
    """Deal members of each ``key`` to tasks (key, i, j), i <= j, that hold blocks i and j.

    ``counted`` has the number of blocks of each key. Every pair meets in one task, at least.
    """
    own = F.pmod(F.xxhash64("c"), F.col("blocks")).alias("block")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    placed = rows.join(counted, key).select(*rows.columns, own, others)
    pair = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    return placed.select(*rows.columns, "block", *pair)


def links_in_groups(
    groups: DataFrame, texts: DataFrame, sizes: DataFrame, similarity: float, block: int
) -> DataFrame:
    """c, n_links: every pair within a group is compared in full; only counts leave a task.

    A group above ``block`` sets (or of long texts that come to as many shingles) is split into blocks, and
    each pair of blocks is one task.
    """
    rows = groups.select("group", F.col("node").alias("c"))
    blocks = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("size") / (block * 1024)))
    counted = rows.join(sizes, "c").groupBy("group").agg(blocks.alias("blocks"))
    full = in_blocks(rows, "group", counted).join(texts, "c")

    def count(table: pa.Table) -> pa.Table:
        return count_links(table, similarity)

    parts = full.groupBy("group", "i", "j").applyInArrow(count, "c long, n_links long")
    return parts.groupBy("c").agg(F.sum("n_links").alias("n_links"))


def links_between_groups(
    apart: DataFrame, pairs: DataFrame, texts: DataFrame, sizes: DataFrame, similarity: float, block: int
) -> DataFrame:
    """Links (a, b) that connect groups within the buckets of ``apart`` (bucket, c, group).

    Small buckets give their pairs of different groups, without those in ``pairs``, which have been
    verified. A member of a larger bucket would have too many; there all members are
    compared within tasks, which return only what connects their groups.
    """
    blocks = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("size") / (block * 1024)))
    counted = apart.join(sizes, "c").groupBy("bucket").agg(F.count("*").alias("k"), blocks.alias("blocks"))
    counted = stored(counted, "counted")
    few = apart.join(counted.where(F.col("k") <= FEW).select("bucket"), "bucket")
    left = few.select("bucket", F.col("c").alias("a"), F.col("group").alias("ga"))
    right = few.select("bucket", F.col("c").alias("b"), F.col("group").alias("gb"))
    rest = left.join(right, "bucket").where("a < b and ga != gb").select("a", "b").distinct()
    rest = rest.join(pairs, ["a", "b"], "left_anti")
    many = counted.where(F.col("k") > FEW).select("bucket", "blocks")
    full = in_blocks(apart, "bucket", many).join(texts, "c")

    def connect(table: pa.Table) -> pa.Table:
        return join_groups(table, similarity)

    large = full.groupBy("bucket", "i", "j").applyInArrow(connect, "a long, b long")
    return verified(rest, texts, similarity, block).unionByName(large)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
    tie: str | None = None, recall: float = RECALL, block: int = BLOCK,
) -> DataFrame:
    """Groups of texts linked by a Jaccard similarity of their five-word shingles; one row per document.

    Returns key, class_id (the smallest key in the group of texts connected by links), n_links
    (other shingle sets linked with this one), n_copies (rows with the same set, this one
    included), kept (one row of each group: smallest ``tie``, which is the key unless given, null last,
    then any one). Texts without words, null and
    empty ones too, are groups of their own without links. An empty table stays empty.

    Rows with equal sets are one class. Classes meet in MinHash bands, as many as ``recall``
    needs for pairs at ``similarity``. In every bucket each class is verified against the
    first on full sets; classes that are then connected need no further pair. Where a bucket
    still holds several groups, its members of different groups are compared, by pairs in a small
    bucket and within tasks in a large one. So a bucket of any size gives few pairs per
    class. Links are then counted within the groups, again in tasks that return counts.
    """
    spark = docs.sparkSession
    ship_code(spark)
    bands, rows_each = bands_for(similarity, recall)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
        F.col(tie or key).alias("tie"), text_or_empty(text).alias("text"),
    )
    rows = stored(rows, "texts")
    signed = stored(signatures(rows, bands, rows_each), "signatures")
    classes = signed.groupBy("cls").agg(
        F.min("row").alias("c"), F.count("*").alias("n_copies"),
        F.first("size").alias("size"), F.first("bands").alias("bands"),
    )
    classes = stored(classes, "classes")
    member = classes.select("c", F.explode("bands").alias("bucket"))
    buckets = member.groupBy("bucket").agg(F.min("c").alias("a"), F.count("*").alias("k")).where("k > 1")
    met = stored(member.join(buckets.drop("k"), "bucket"), "buckets")
    pairs = stored(met.where("a < c").select("a", F.col("c").alias("b")).distinct(), "pairs")
    involved = met.select("c").distinct()
    texts = stored(rows.select(F.col("row").alias("c"), "text").join(involved, "c", "left_semi"), "involved")
    sure = stored(verified(pairs, texts, similarity, block), "links")
    groups = components(sure)

    at = met.join(groups, met["c"] == groups["node"], "left")
    at = at.select("bucket", "c", F.coalesce("group", "c").alias("group"))
    ends = at.groupBy("bucket").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    apart = ends.where("low < high")
    at = stored(at.join(apart.select("bucket"), "bucket"), "apart")
    sizes = classes.select("c", "size")
    more = stored(links_between_groups(at, pairs, texts, sizes, similarity, block), "links")
    if not more.isEmpty():
        groups = components(sure.unionByName(more))
    counts = links_in_groups(groups, texts, sizes, similarity, block)

    own = classes.select("cls", "c", "n_copies").join(groups, classes["c"] == groups["node"], "left")
    own = own.select("cls", "c", "n_copies", F.coalesce("group", "c").alias("group")).join(counts, "c", "left")
    own = own.select("cls", "group", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    placed = stored(signed.select("row", "key", "tie", "cls").join(own, "cls").drop("cls"), "placed")
    best = F.min(F.struct(F.col("tie").isNull().alias("none"), "tie", "row", "key")).alias("best")
    best = placed.groupBy("group").agg(best)
    linked = placed.join(best, "group").select(
        "key", F.col("best.key").alias("class_id"), "n_links", "n_copies",
        (F.col("row") == F.col("best.row")).alias("kept"),
    )
    alone = rows.select("row", "key").join(signed.select("row"), "row", "left_anti").select(
        "key", F.col("key").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("n_copies"), F.lit(True).alias("kept"),
    )
    return linked.unionByName(alone).withColumnRenamed("key", key)
