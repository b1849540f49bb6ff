"""The limits of a language come from all held-out texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.llm import language

LONG = "the quick brown fox jumps over the lazy dog and then it runs away from the old house "


def test_rare_lengths_have_limits_of_their_own(spark):
    """Forty long texts among 24,000 short ones are enough for a limit; a sample of 8,000 held 13 or so."""
    docs = spark.range(96_000).withColumnRenamed("id", "doc_id").where(language.held_out("doc_id"))
    docs = docs.withColumn("lang", F.lit("en"))
    rare = F.xxhash64(F.col("doc_id") + 7) % 600 == 0
    docs = docs.withColumn("text", F.when(rare, F.lit(LONG)).otherwise(F.lit("ox")))
    assert 30 <= docs.where(F.length("text") > 2).count() <= 85 < 8000 < docs.count()
    learned = language.learn_prototypes(spark.createDataFrame([(LONG, "en")], "text string, lang string"))
    found = language.limits(docs, *learned)
    assert found[6] > 0.9 and found[1] < 0.9
