"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from tomewise import queries
from tomewise.operators import network, similarity, tfidf
from tomewise.plans.storage import spread, store
from tomewise.queries import QUERIES
from tomewise.sources import documents

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> list[str]:
    return re.findall(r"Exchange .*", text)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert not any(python in text for python in ("EvalPython", "MapInPandas", "InArrow"))


def test_scans_read_two_columns(spark):
    text = plan(QUERIES["tfidf"](spark, SF_DIR))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_target_is_pushed_into_the_scan(spark):
    text = plan(QUERIES["top_terms_for_doc"](spark, SF_DIR))
    assert "EqualTo(doc_id,10)" in text


def test_terms_need_no_shuffle(spark):
    docs = documents(spark, SF_DIR)
    assert shuffles(plan(tfidf.term_frequency(docs, "doc_id"))) == []


def test_weights_need_no_shuffle_with_a_small_vocabulary(spark):
    text = plan(tfidf.tfidf(documents(spark, SF_DIR), "doc_id"))
    assert [x for x in shuffles(text) if "hashpartitioning" in x] == []


def test_texts_are_tokenized_once_per_pass(spark):
    text = plan(tfidf.term_frequency(documents(spark, SF_DIR), "doc_id"))
    assert text.count("[^a-z]+") == 1


def test_header_is_matched_once_under_a_filter(spark):
    text = plan(QUERIES["books_complete"](spark, SF_DIR))
    assert text.count("Author:[") == plan(QUERIES["authors"](spark, SF_DIR)).count("Author:[")


def test_unit_vectors_shuffle_once(spark):
    weights = store(tfidf.tfidf(documents(spark, SF_DIR), "doc_id"), "weights")
    text = plan(similarity.unit_vectors(weights, "doc_id"))
    assert len(shuffles(text)) == 1


def test_ranks_are_cut_before_the_shuffle(spark):
    weights = store(tfidf.tfidf(documents(spark, SF_DIR), "doc_id"), "weights")
    text = plan(tfidf.top_terms_per_document(weights, "doc_id"))
    assert "WindowGroupLimit" in text.split("Exchange hashpartitioning(doc_id")[1]


def test_copies_are_cut_before_the_shuffle(spark, monkeypatch):
    stored = {}

    def keep(df, name):
        stored[name] = plan(df)
        return store(df, name)

    monkeypatch.setattr(similarity, "store", keep)
    QUERIES["top_similar_pairs"](spark, SF_DIR)
    assert "WindowGroupLimit" in stored["copies"].split("Exchange hashpartitioning(bag")[1]


def test_only_bounded_tables_are_broadcast_in_the_year_join(spark):
    books = store(
        spark.createDataFrame([("a", "A", 1990)], "file_name string, author string, release_year int"),
        "books",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(network.book_edges(books))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [year_late" in text
    assert all("year_late" in x for x in re.findall(r"BroadcastHashJoin .*", text))


def test_sides_of_the_year_join_are_not_broadcast_for_a_short_file(spark):
    """Their rows are multiplied by years and chunks, which the size of a stored table says nothing of."""
    rows = [(f"b{i}", f"A{i}", 1990 + i % 3) for i in range(9)]
    books = store(spark.createDataFrame(rows, "file_name string, author string, release_year int"), "books")
    text = plan(network.book_edges(books))
    assert "SortMergeJoin [year_late" in text
    assert not [x for x in re.findall(r"BroadcastHashJoin .*", text) if "chunk" in x.split("],")[0]]


@pytest.fixture
def stored(monkeypatch):
    """The plans of all tables that are stored, by name."""
    plans = {}

    def keep(df, name):
        plans.setdefault(name, []).append(plan(df))
        return store(df, name)

    for module in (similarity, tfidf, network, queries):
        monkeypatch.setattr(module, "store", keep)
    return plans


def test_author_edges_shuffle_no_names(spark, stored):
    """Profile pairs are dealt out before their authors are spelled out, and are summed without a sort of all rows."""
    rows = [(f"b{i}", f"A{i}", 1990 + i % 3) for i in range(9)]
    books = spark.createDataFrame(rows, "file_name string, author string, release_year int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(network.author_edges(store(network.author_profiles(books), "profiles")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 2
    assert [x for x in shuffles(text) if "hashpartitioning" in x and "late_piece" not in x] == []
    assert "SortAggregate" not in stored["profile-edges"][0]


def test_all_pairs_shuffle_no_products(spark, monkeypatch):
    """Words of documents are dealt out by cell; joins and sums over pairs take place there."""
    rows = [(f"b{i}", f"cat dog {'abc'[i % 3] * 3} {'stuv'[i % 4] * 3}") for i in range(12)]
    books = spark.createDataFrame(rows, "file_name string, text string")
    monkeypatch.setattr(similarity, "CHUNK_POSTINGS", 4)
    text = plan(similarity.cosine_pairs(store(tfidf.tfidf(books), "weights")))
    assert len([x for x in shuffles(text) if "REPARTITION_BY_NUM" in x and "cell" in x]) == 2
    assert "ENSURE_REQUIREMENTS" not in text


def test_words_of_candidates_are_shuffled_by_document(spark, monkeypatch):
    """A word is dealt out once for each cell of its document, not for each pair."""
    rows = [(f"b{i}", f"cat dog {'abc'[i % 3] * 3} {'stuv'[i % 4] * 3}") for i in range(12)]
    weights = store(tfidf.tfidf(spark.createDataFrame(rows, "file_name string, text string")), "weights")
    units = store(similarity.unit_vectors(weights), "units")
    candidates = store(similarity._candidates(units, "file_name", 0.3), "candidates")
    assert candidates.count() == 30
    monkeypatch.setattr(similarity, "CHUNK_POSTINGS", 2)
    text = plan(similarity._cosines(units, candidates, "file_name"))
    assert not [x for x in shuffles(text) if "word" in x]
    assert not [x for x in shuffles(text) if "ENSURE_REQUIREMENTS" in x and "book1" in x and "book2" in x]


def test_candidates_shuffle_no_products(spark):
    """Where products outnumber words, words are dealt out by cell, and products are summed in place."""
    rows = [(f"b{i}", f"cat dog {'abc'[i % 3] * 3} {'stuv'[i % 4] * 3}") for i in range(60)]
    weights = store(tfidf.tfidf(spark.createDataFrame(rows, "file_name string, text string")), "weights")
    text = plan(similarity._candidates(store(similarity.unit_vectors(weights), "units"), "file_name", 0.3))
    assert "SortMergeJoin [cell" in text and "ENSURE_REQUIREMENTS" not in text


def test_best_pairs_store_no_weights(spark, stored):
    """With enough copies only the words that the search reads are stored; documents are shuffled before they are spelled out."""
    rows = [(f"b{i}", f"cat dog {'abc'[i % 3] * 3} {'stuv'[i % 4] * 3}") for i in range(60)]
    terms = tfidf.stored_terms(spark.createDataFrame(rows, "file_name string, text string"))
    assert similarity.top_similar_pairs(terms).count() == 20
    assert "weights" not in stored and "heads" in stored
    for text in stored["heads"]:
        assert text.count("Sort [file_name") == 1
        assert not [x for x in shuffles(text) if "hashpartitioning(file_name" in x and "BY_NUM" not in x]


@pytest.mark.parametrize("broadcast_bytes", [1 << 25, 300])
def test_unit_vectors_by_document_shuffle_no_words(spark, broadcast_bytes):
    """Parts of the vocabulary that are looked up apart come together without another shuffle."""
    terms = tfidf.stored_terms(documents(spark, SF_DIR), "doc_id")
    weights = tfidf.weigh_by_document(terms, tfidf.vocabulary(terms), "doc_id", broadcast_bytes)
    text = plan(similarity.unit_vectors(weights, "doc_id"))
    by_document = [x for x in shuffles(text) if "hashpartitioning(doc_id" in x]
    assert len(by_document) == (1 if broadcast_bytes > 300 else 2)
    assert all("REPARTITION_BY_NUM" in x for x in by_document)


@pytest.mark.parametrize("name", ["tfidf", "doc_vectors", "similar_pairs", "top_similar_pairs", "avg_similarity"])
def test_texts_are_read_once(spark, stored, name):
    last = plan(QUERIES[name](spark, SF_DIR))
    plans = [last, *(text for texts in stored.values() for text in texts)]
    assert sum(text.count("ReadSchema: struct<doc_id:bigint,text:string>") for text in plans) == 1
    assert not any("InArrow" in text or "Python" in text or "CartesianProduct" in text for text in plans)


def test_the_average_sorts_no_postings_by_document(spark, stored):
    text = plan(QUERIES["avg_similarity"](spark, SF_DIR))
    assert "Sort [doc_id" not in text and all("Sort [doc_id" not in t for texts in stored.values() for t in texts)


def test_inputs_of_enough_splits_are_not_dealt_out(spark):
    few = spark.range(100).coalesce(1)
    many = spark.range(0, 100, 1, 32)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(many).rdd.getNumPartitions() == 32
