"""Licence paragraphs: a trained classifier with an unknown class, confirmed by templates."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.shared import stored, text_or_empty

#: Notices by which the families are commonly declared.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                   "this file except in compliance with the License."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms "
            "of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Released under the BSD License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                 "International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related "
            "rights to this work. CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Families with near relatives, and word pairs of which a notice of the family holds one:
#: a notice of the Affero licence holds nearly all of the plain one's.
MARKS = {
    "GPL": ["gnu general"],
    "LGPL": ["gnu lesser"],
    "AGPL": ["gnu affero"],
    "CC-BY": ["by 4", "attribution 4"],
    "CC-BY-SA": ["by sa"],
    "CC-BY-NC": ["by nc", "attribution noncommercial"],
}
NONE, UNKNOWN = "none", "unknown"
FAMILIES = [NONE, *sorted({family for family, _ in TEMPLATES})]

#: Line ends around lines without a letter or digit.
BREAK = r"(?:\r\n?+|\n)(?:[^\p{L}\p{N}\r\n]*+(?:\r\n?+|\n))+"
#: Words of a window, and words that neighbours share: more than the longest template has.
WINDOW, OVERLAP = 128, 40
#: Documented bounds of the training sample: documents, negative windows, positives per template.
SAMPLED, NEGATIVES, POSITIVES = 500, 4000, 60
#: Words around the notice in every other positive; the others fill a window.
SHORT = 32
DIMENSIONS = 1 << 14
#: Share of a template's words and word pairs that a confirmed window must hold.
CONFIRMED = 0.8
#: Share of the windows without a template that may be called a licence.
FALSE_RATE = 0.001

#: A family, a template's words, and its distinct words and pairs.
Template = tuple[str, list[str], list[str]]


def words_of(text: Column) -> Column:
    """Words of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def with_grams(rows: DataFrame) -> DataFrame:
    """Add grams (words and neighbouring pairs) to rows with words."""
    n = F.size("words")
    pairs = F.transform(
        F.sequence(F.lit(1), n - 1),
        lambda i: F.concat(F.get("words", i - 1), F.lit(" "), F.get("words", i)),
    )
    return rows.withColumn("grams", F.when(n > 1, F.concat("words", pairs)).otherwise(F.col("words")))


def windows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """row (one number per input row), key, place, words: the windows of every paragraph.

    ``place`` is the number of the paragraph: lines up to one without a letter or digit, as
    notices are wrapped. A paragraph has one window or more; what is no longer than OVERLAP
    words lies within one of them.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.split(text_or_empty(text), BREAK).alias("parts"),
    )
    rows = rows.select("row", "key", F.posexplode("parts").alias("place", "paragraph"))
    rows = rows.select("row", "key", "place", words_of(F.col("paragraph")).alias("all"))
    step = WINDOW - OVERLAP
    last = F.greatest(F.lit(0), F.ceil((F.size("all") - OVERLAP) / step).cast("int") - 1)
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("all", i * step + 1, WINDOW))
    return rows.select("row", "key", "place", F.explode(cut).alias("words"))


def read_templates(spark: SparkSession) -> list[Template]:
    rows = spark.createDataFrame(TEMPLATES, "family string, notice string")
    found = with_grams(rows.select("family", words_of(F.col("notice")).alias("words")))
    found = found.withColumn("grams", F.array_distinct("grams"))
    return [(r["family"], r["words"], r["grams"]) for r in found.collect()]


def needed(own: list[str]) -> int:
    """Grams of a template that a confirmed window holds at least."""
    return next(n for n in range(len(own) + 1) if n / len(own) >= CONFIRMED)


def holds_any(grams: list[str]) -> Column:
    return F.arrays_overlap(F.col("grams"), F.array(*map(F.lit, grams)))


def confirmed(templates: list[Template]) -> Column:
    """Every family of which the row's grams hold a template, in order.

    Of any n - needed + 1 grams of a template with n, a confirmed window holds one. So windows
    without one of these, the longest pairs, are told at one look, and none is lost.
    """
    marks, found = set(), []
    for family, _, own in templates:
        some = sorted(own, key=lambda gram: (" " not in gram, -len(gram), gram))
        marks |= set(some[: len(own) - needed(own) + 1])
        held = F.size(F.array_intersect(F.col("grams"), F.array(*map(F.lit, own)))) >= needed(own)
        if family in MARKS:
            held &= holds_any(MARKS[family])
        found.append(F.when(held, F.lit(family)))
    families = F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))
    none = F.array().cast("array<string>")
    return F.when(holds_any(sorted(marks)), families).otherwise(none)


def training_rows(docs: DataFrame, text: str, templates: list[Template]) -> DataFrame:
    """Labelled windows: family, grams.

    Negatives are the windows of the SAMPLED texts with the smallest hashes, NEGATIVES
    at most, without those that hold a template, and the empty window. Positives are
    the templates, alone and within the words of POSITIVES negatives, from the first place
    to the last, because a notice may stand anywhere in a window.
    """
    spark = docs.sparkSession
    body = docs.select(text_or_empty(text).alias("body"))
    body = body.withColumn("hash", F.xxhash64("body"))
    least = body.select("hash").distinct().orderBy("hash").limit(SAMPLED)  # hashes, not texts, meet
    sampled = body.join(F.broadcast(least), "hash", "left_semi")
    cut = windows(sampled, "hash", "body").select("words").distinct()
    some = with_grams(cut.orderBy(F.xxhash64("words"), "words").limit(NEGATIVES))
    negatives = stored(some.where(F.size(confirmed(templates)) == 0).select("words"), "negatives")
    heads = negatives.where(F.size("words") > 0).orderBy(F.xxhash64("words"), "words").limit(POSITIVES)
    around = [r["words"][: SHORT if k % 2 else WINDOW] for k, r in enumerate(heads.collect())]
    positives = []
    for family, notice, _ in templates:
        positives.append((family, notice))
        for k, words in enumerate(around):
            words = words[: WINDOW - len(notice)]
            at = len(words) * k // max(1, len(around) - 1)
            positives.append((family, words[:at] + notice + words[at:]))
    rows = spark.createDataFrame([*positives, (NONE, [])], "family string, words array<string>")
    return with_grams(rows.unionByName(negatives.select(F.lit(NONE).alias("family"), "words")))


class LicenceModel:
    """The fitted classifier and the templates."""

    def __init__(self, pipeline: PipelineModel, templates: list[Template]):
        self.pipeline, self.templates = pipeline, templates

    def scan(self, rows: DataFrame) -> DataFrame:
        """Replace the words of every window by score and families.

        score is the probability of being a licence at all. families are all those of which
        the window holds a template to at least CONFIRMED, whatever the score.
        """
        scored = self.pipeline.transform(with_grams(rows))
        score = 1 - vector_to_array("probability")[0]
        kept = [c for c in rows.columns if c != "words"]
        return scored.select(*kept, score.alias("score"), confirmed(self.templates).alias("families"))


def train(docs: DataFrame, text: str = "text") -> LicenceModel:
    """Fit on the bounded sample."""
    templates = read_templates(docs.sparkSession)
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
    rows = training_rows(docs, text, templates)
    rows = stored(rows.select(label.cast("double").alias("label"), "grams"), "training")
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=DIMENSIONS, binary=True)
    fit = LogisticRegression(regParam=1e-4, maxIter=40, family="multinomial")
    return LicenceModel(PipelineModel([hashing, fit.fit(hashing.transform(rows))]), templates)


def threshold_of(scanned: DataFrame) -> float:
    """Score that no more than FALSE_RATE of all windows without a template exceed, 0.5 to 0.99."""
    others = scanned.where(F.size("families") == 0)
    high = others.agg(F.percentile_approx("score", 1 - FALSE_RATE, 100_000)).first()[0]
    return min(max(0.5, high or 0.0), 0.99)


def licence_scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Licences of every document; one row per input row.

    Returns key, n_paragraphs, families (all that a window confirms, in order), n_unknown
    (paragraphs with a window that reads like a licence, but without a template), score (the
    highest probability of a window that counts as a licence, null without any). A paragraph
    is a run of lines up to one without a letter or digit; null and empty texts have one empty
    paragraph. Repeated rows are judged alike. The scores of all windows are stored, because the threshold comes from them.
    An empty table stays empty.
    """
    found = stored(train(docs, text).scan(windows(docs, key, text)), "scanned")
    sure = F.size("families") > 0
    likely = F.col("score") > threshold_of(found)
    unknown = F.array_except(
        F.collect_set(F.when(likely, F.col("place"))), F.collect_set(F.when(sure, F.col("place")))
    )
    return found.groupBy("row", "key").agg(
        (F.max("place") + 1).cast("long").alias("n_paragraphs"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("families")))).alias("families"),
        F.size(unknown).cast("long").alias("n_unknown"),
        F.max(F.when(sure | likely, F.col("score"))).alias("score"),
    ).select(F.col("key").alias(key), "n_paragraphs", "families", "n_unknown", "score")
