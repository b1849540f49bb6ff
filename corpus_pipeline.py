"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor and returns the
columns of documents, the last one the packed pieces. Between the stages tables are written
and read back; a stage deletes the helper tables of those before it. Rows are numbered inside a stage,
so null and repeated doc_ids stay apart.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import exact_dedup, jaccard, language, packing, shared, suffix_dedup
from ledgerspark.llm.shared import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(f: Stage) -> Stage:
    """Delete what earlier stages have stored before this one begins."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with shared.stage(docs):
            return f(spark, docs, sf_dir)

    return run_stage


def _numbered(docs: DataFrame) -> DataFrame:
    number = F.monotonically_increasing_id().alias("number")
    return stored(docs.select(number, *COLUMNS), "numbered", "zstd")


def _kept(numbered: DataFrame, judged: DataFrame) -> DataFrame:
    stays = judged.where("kept").select("number")
    return numbered.join(stays, "number", "left_semi").select(*COLUMNS)


@stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and texts far from every learned language.

    Null and empty texts have no letters and go. Rows with a null lang or doc_id teach nothing and
    are judged like all others. Repeated rows are judged alike. An empty table stays empty.
    """
    learn = docs.where(~language.held_out("doc_id") & F.col("doc_id").isNotNull())
    learned = language.learn_prototypes(learn)
    limits = F.array(*map(F.lit, language.limits(docs, *learned)))
    judged = language.predict_languages(docs.select(*COLUMNS), *learned)
    far = F.col("score") < F.coalesce(F.get(limits, language.magnitude("text")), F.lit(0.0))
    return judged.where((F.col("lang_pred") != language.UNKNOWN) & ~far).select(*COLUMNS)


@stage
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of texts that are equal but for white space.

    The longest original stays, then the smallest doc_id, nulls last, then the first row.
    Null texts are empty and one group with empty and blank ones. An empty table stays empty.
    """
    numbered = _numbered(docs)
    half = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return _kept(numbered, exact_dedup.exact_dedup(numbered, half, "number", tie="doc_id"))


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of texts linked by similar shingles.

    Of rows with one doc_id one stays. Texts without words, null and empty ones too, are groups of
    their own and stay. An empty table stays empty.
    """
    numbered = _numbered(docs)
    return _kept(numbered, jaccard.near_duplicates(numbered, "number", tie="doc_id"))


@stage
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove strings of 200 bytes that start in more than one place; every row stays.

    All copies of a string go, so there are no ties. Characters cut through leave whole ones
    only; null texts become empty. An empty table stays empty.
    """
    carried = [c for c in COLUMNS if c not in ("text", "n_chars")]
    out = suffix_dedup.remove_repeats(docs, carried, as_text=True)
    size = F.length("kept").cast("long").alias("n_chars")
    return out.select("doc_id", F.col("kept").alias("text"), "lang", "source", size)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token ids of all documents into sequences.

    Null and empty texts are one piece of the end id. Pieces of equal length are interchangeable. An
    empty table gives no pieces.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard", near_copies),
    ("suffix_dedup", repeated_strings),
    ("packing", packed),
]
#: Learned models, sorting of suffixes and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
