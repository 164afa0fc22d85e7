"""The queries of this subpackage by name, with their parameters, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewise.llm import bpe, decontaminate, filter_audit, manifest, pii
from tomewise.llm.ann import nearest
from tomewise.llm.common import held_out, table
from tomewise.llm.jaccard import near_duplicates
from tomewise.llm.language import add_language, learn_languages
from tomewise.llm.licenses import scan
from tomewise.llm.packing import pack
from tomewise.llm.quality import judge
from tomewise.llm.toxicity import add_toxicity, learn_toxicity
from tomewise.llm.wrappers import learn_wrappers, main_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    model = learn_languages(docs, learn=~out)
    return add_language(docs.select("doc_id", "text", out.alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 5, 0)
    model = learn_toxicity(docs, table(spark, sf_dir, "labels"), learn=~out)
    scored = add_toxicity(docs.select("doc_id", "text", out.alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


@query
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digest(docs, pii.learn_field(docs))


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


@query
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = main_text(pages, learn_wrappers(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.digest(table(spark, sf_dir, "documents"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES |= {
    "op11_manifest": manifest.ORACLE_SQL,
    "op12_filter_audit": filter_audit.ORACLE_SQL,
    "op13_decontamination": decontaminate.ORACLE_SQL,
}
