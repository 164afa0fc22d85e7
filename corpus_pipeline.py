"""A training corpus from the documents table: language, toxicity, near copies, private data, packing.

Each stage takes the documents that the one before kept, with all their columns, and its decisions take effect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewise.llm.common import held_out, small, store, table
from tomewise.llm.jaccard import near_duplicates
from tomewise.llm.language import UNKNOWN, add_language, learn_languages
from tomewise.llm.packing import pack
from tomewise.llm.pii import redact
from tomewise.llm.toxicity import add_toxicity, learn_toxicity

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that was learned; those without text or without a letter go.

    Where nothing can be learned, all documents with a letter stay.
    """
    model = learn_languages(docs, learn=~held_out("doc_id", 4, 2))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = add_language(docs, model, lang_pred="_lang", score="_score")
    return found.filter(F.col("_lang") != UNKNOWN).select(docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that score below one half."""
    model = learn_toxicity(docs, table(spark, sf_dir, "labels"), learn=~held_out("doc_id", 5, 0))
    return add_toxicity(docs, model, score="_score").filter(F.col("_score") < 0.5).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: that with the least id, rows without an id last.

    Of rows that repeat a text and its id, any one. Rows without words are nobody's copies and all stay.
    """
    row = next(name for i in range(len(docs.columns) + 1) if (name := f"row_{i}") not in docs.columns)
    # Stored with the rows, so that a number means the same row in every job.
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.monotonically_increasing_id().alias("at"))
    numbered = store(docs.withColumn(row, order), "numbered-rows")
    groups = near_duplicates(numbered, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT, doc_id=row)
    gone = groups.filter(F.col(f"{row}.at") != F.col("component_id.at")).select(F.col(f"{row}.at").alias("at"))
    gone = small(store(gone, "near-copies"))
    return numbered.join(gone, F.col(f"{row}.at") == gone["at"], "left_anti").select(docs.columns)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by the name of its kind, and count the characters anew."""
    return redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 2048 tokens."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("private_data", private_data),
    ("packing", packing),
]

# Language models, classifiers and tokenizers can not be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each one's result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
