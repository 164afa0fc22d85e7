"""The pipeline stage by stage, and every query on the smallest tables."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import expected_groups, frame, near_copies, sentence
from tomewise.llm import pii
from tomewise.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
KEYS = {
    "op1_personal_data": "doc_id", "op3_toxicity": "doc_id", "op4_byte_bpe": "doc_id", "op5_quality": "doc_id",
    "op6_jaccard": "doc_id", "op7_licenses": "doc_id", "op9_main_text": "page_id", "op10_language": "doc_id",
}


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", list(KEYS))
def test_a_row_for_each_row(spark, name):
    table = "pages" if name == "op9_main_text" else "documents"
    got = QUERIES[name](spark, SF_DIR).collect()
    want = spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(KEYS[name]).collect()
    assert Counter(r[0] for r in got) == Counter(r[0] for r in want)


def test_nearest_and_packing_on_tables(spark):
    asked = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").filter("vec_id % 50 = 0").count()
    assert QUERIES["op2_nearest"](spark, SF_DIR).count() == 5 * asked
    pieces = QUERIES["op8_packing"](spark, SF_DIR)
    total = pieces.agg(F.sum("length"), F.count_distinct("sequence_id")).head()
    assert total[1] <= -(-total[0] // 2048) + 1


def test_stages_keep_columns_and_take_effect(spark, documents):
    docs = documents
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        # A table is read again between stages, as in a run of the pipeline.
        path = corpus_pipeline.store(stage(spark, docs, SF_DIR), name)
        assert path.columns == documents.columns
        kept[name] = path.count()
        docs = path
    assert documents.count() >= kept["language"] > kept["toxicity"] > kept["near_copies"] == kept["private_data"]
    texts = [r.text for r in docs.select("text").collect()]
    assert not any(pii.base_spans(t) for t in texts)
    packed = corpus_pipeline.packing(spark, docs, SF_DIR)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()


def test_near_copies_leave_one_of_each_group(spark):
    rows = near_copies()
    got = Counter(r.doc_id for r in corpus_pipeline.near_copies(spark, frame(spark, rows), SF_DIR).collect())
    want = Counter()
    groups = set()
    for (doc_id, size, group), n in expected_groups(rows, 5, 80).items():
        if not size:
            want[doc_id] += n
        elif group is not None:
            groups.add(group)
    # Groups without an id leave a row without one.
    alone = sum(1 for (_, size, group) in expected_groups(rows, 5, 80) if size and group is None)
    assert got - want == Counter(groups) + Counter({None: alone})


def test_near_copies_go_by_row(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(3, a), (7, a), (7, b), (None, a), (None, None), (9, ""), (9, "")]
    docs = frame(spark, rows).withColumn("row_0", F.lit("x"))
    got = corpus_pipeline.near_copies(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(3, a), (7, b), (None, None), (9, ""), (9, "")])


def test_without_a_learned_language_documents_with_letters_stay(spark):
    docs = frame(spark, [(1, "plain text", None), (2, "12 ½", None), (3, None, None), (4, "é", None)])
    got = corpus_pipeline.language(spark, docs, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == [1, 4]


def test_stages_with_repeated_and_missing_ids(spark):
    words = "some words of a text that is not short"
    docs = frame(spark, [(None, words), (None, words + " x y"), (5, words * 2), (5, "é" * 9000), (6, "")], 2)
    for stage in (corpus_pipeline.toxicity, corpus_pipeline.private_data):
        got = stage(spark, docs, SF_DIR)
        assert got.columns == docs.columns and got.count() == 5
    assert corpus_pipeline.packing(spark, docs, SF_DIR).filter("piece = 0").count() == 5


def test_language_and_odd_rows(spark):
    rows = [(1, None, "aa"), (2, "", None), (3, "12 !", "aa"), (4, "½ ² Ⅷ ③ 12", "aa"), *((i, sentence(random.Random(i), 9), "aa") for i in range(10, 40))]
    got = corpus_pipeline.language(spark, frame(spark, rows), SF_DIR)
    assert sorted(r.doc_id for r in got.collect()) == list(range(10, 40))
    empty = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
