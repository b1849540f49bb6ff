"""How much each of several filters removes, in every order in which they can be applied.

A document is its mask: the set of filters it fails. In an order of the filters it is removed at
the first step whose filter is in its mask. Orders are ranked as words (Lehmer rank), so all
orders that begin alike are neighbours: those that remove a mask at step s by filter f begin with
s - 1 filters outside the mask and then f, and fill an interval of ranks for each such beginning.
Counts are added where an interval starts and taken off where it ends, and a running sum over the
ranks gives the documents removed in each order and step. The work after one pass over the texts
depends on the number of parts and filters only.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, permutations
from math import factorial
from operator import add

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.shared import stored, text_or_empty

LETTERS = "ABCDE"
SPACES = r"[\x20\x09-\x0D]+"
MOST_FILTERS = 7


def text_checks(rows: DataFrame) -> DataFrame:
    """Replace the column text (not null) by its SHA-256 and the mask of the conditions A to D."""
    others = [c for c in rows.columns if c != "text"]
    words = F.split("text", SPACES)  # empty at the ends, if the text has spaces there
    rows = rows.select("*", words.alias("words"))
    first, last = F.get("words", F.lit(0)) == "", F.element_at("words", -1) == ""
    edges = first.cast("int") + (last & (F.size("words") > 1)).cast("int")
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    rows = rows.select(
        *others,
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (F.size("words") - edges).alias("n_words"),
        (F.size(F.array_distinct("words")) - (edges > 0).cast("int")).alias("n_distinct"),
        (F.lit(100) * capitals > F.lit(3) * F.length("text")).alias("capitals"),
        F.col("text").rlike(r"[#$%&*|]").alias("symbols"),
    )
    checks = [F.col("n_words") < 200, F.lit(100) * F.col("n_distinct") < F.lit(50) * F.col("n_words")]
    checks += [F.col("capitals"), F.col("symbols")]
    bits = [F.when(check, 1 << i).otherwise(0) for i, check in enumerate(checks)]
    return rows.select(*others, "digest", reduce(add, bits).alias("mask"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and mask: part, mask int, n, good, toxic (long).

    ``docs`` has doc_id, text and lang, ``labels`` doc_id, quality and toxic; further columns
    are not read. Null texts are empty and a null lang is the part ''. Bit i of the mask is set when
    filter i of ABCDE fails. A document fails E when a row with a smaller doc_id has the same text;
    so rows of one doc_id do not make each other fail, and a null doc_id, which is not larger than
    any, never fails. A document is good (toxic) when any of its labels says so.

    Equal texts share A to D, so rows meet again only as counts: by document, with the labels,
    by text and part, and by text. A text or a doc_id that fills a third of the table is counted in
    each task before it is shuffled.
    """
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text_or_empty("text").alias("text"),
    )
    rows = text_checks(rows).groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    rows = rows.join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    known = F.col("doc_id").isNotNull()
    rows = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("known"),
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("of_least"),  # one row for each doc_id here
    )
    first = F.col("least") == F.min("least").over(Window.partitionBy("digest"))
    repeats = F.col("known") - F.when(first, F.col("of_least")).otherwise(0)
    rows = rows.select("*", repeats.alias("repeats"))
    repeated = 1 << LETTERS.index("E")
    rows = rows.select(
        "part", "good", "toxic",
        F.inline(
            F.array(
                F.struct((F.col("mask") + repeated).alias("mask"), F.col("repeats").alias("n")),
                F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("repeats")).alias("n")),
            )
        ),
    )
    return rows.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("good") * F.col("n")).alias("good"),
        F.sum(F.col("toxic") * F.col("n")).alias("toxic"),
    )


def lehmer_rank(prefix: tuple[int, ...], n: int) -> int:
    """Rank of the first order of ``n`` filters that begins with ``prefix``."""
    rank = 0
    for i, x in enumerate(prefix):
        smaller_left = x - sum(y < x for y in prefix[:i])
        rank += smaller_left * factorial(n - 1 - i)
    return rank


def removal_intervals(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) for every beginning that removes a mask."""
    out = []
    for size in range(1, n + 1):
        for fails in combinations(range(n), size):
            mask, passes = sum(1 << f for f in fails), [f for f in range(n) if f not in fails]
            for step in range(1, len(passes) + 2):
                for before in permutations(passes, step - 1):
                    for f in fails:
                        start = lehmer_rank((*before, f), n)
                        out.append((mask, step, start, start + factorial(n - step)))
    return out


def audit(spark: SparkSession, counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order and step, from ``counts`` as ``mask_counts`` returns them.

    Returns part, filter_order, step int, and as long: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley. Steps that remove nothing are rows of zeros. Without
    documents there are no parts and no rows.
    """
    n = len(letters)
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    orders = ["".join(o) for o in permutations(letters)]
    spans = spark.createDataFrame(removal_intervals(n), "mask int, step int, first int, after int")
    sums = ["removed", "good_lost", "toxic_lost"]
    of = dict(zip(sums, ["n", "good", "toxic"], strict=True))
    ends = [
        F.struct(F.col(at).alias("rank"), *[(sign * F.col(of[s])).alias(s) for s in sums])
        for at, sign in (("first", F.lit(1)), ("after", F.lit(-1)))
    ]
    # The intervals are fixed by the number of filters: 840 rows for five of them.
    marks = counts.join(F.broadcast(spans), "mask").select("part", "step", F.inline(F.array(*ends)))
    scaffold = counts.select("part").distinct()
    scaffold = scaffold.select("part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    ranks = F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1)))
    scaffold = scaffold.select("part", "step", ranks.alias("rank"), *[F.lit(0).alias(s) for s in sums])
    steps = marks.where(F.col("rank") < len(orders)).unionByName(scaffold)
    steps = steps.groupBy("part", "step", "rank").agg(*[F.sum(s).alias(s) for s in sums])
    along = Window.partitionBy("part", "step").orderBy("rank")
    steps = steps.select("part", "step", "rank", *[F.sum(s).over(along).alias(s) for s in sums])
    named = F.get(F.array(*map(F.lit, orders)), F.col("rank"))
    steps = steps.select("*", named.alias("filter_order"))
    steps = steps.withColumn("letter", F.col("filter_order").substr(F.col("step"), F.lit(1)))
    bits = [F.struct(F.lit(x).alias("letter"), F.lit(1 << i).alias("bit")) for i, x in enumerate(letters)]
    each = counts.select("part", "mask", "n", F.inline(F.array(*bits)))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    totals = each.groupBy("part", "letter").agg(
        F.sum("n").alias("documents"),
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n")).otherwise(0)).alias("unique_fails"),
    )
    so_far = F.sum("removed").over(Window.partitionBy("part", "rank").orderBy("step"))
    everywhere = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return steps.join(totals, ["part", "letter"]).select(
        "part",
        "filter_order",
        "step",
        (F.col("documents") - so_far).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails",
        "good_lost",
        "toxic_lost",
        everywhere.alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the filters A to E over ``docs``; the counts are written once."""
    return audit(docs.sparkSession, stored(mask_counts(docs, labels), "masks"))
