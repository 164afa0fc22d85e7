from __future__ import annotations

from collections import Counter

import pytest

from tests import corpus
from tomewise.operators import tfidf


@pytest.fixture(scope="module")
def books():
    return corpus.make(30, seed=3)


@pytest.fixture(scope="module")
def df(spark, books):
    return spark.createDataFrame(books, "file_name string, text string").cache()


def test_term_counts(df, books):
    got = {(r.file_name, r.word): (r.term_count, r.word_count) for r in tfidf.term_counts(df).collect()}
    want = {}
    for key, text in books:
        words = text.split()
        want |= {(key, w): (n, len(words)) for w, n in Counter(words).items()}
    assert got == want


def check_weights(rows, books):
    got = {(r.file_name, r.word): r.tfidf for r in rows}
    want = {(k, w): x for k, v in corpus.weights(books).items() for w, x in v.items()}
    assert got.keys() == want.keys()
    for at in want:
        assert got[at] == pytest.approx(want[at], abs=1e-12)


def test_weights_with_broadcast_vocabulary(df, books):
    check_weights(tfidf.tfidf(df).collect(), books)


@pytest.mark.parametrize("frequent_words", [1, 12, 100_000])
def test_weights_with_large_vocabulary(df, books, frequent_words):
    split = tfidf.tfidf(df, broadcast_bytes=0, frequent_words=frequent_words)
    check_weights(split.collect(), books)


def test_shares_of_a_document_add_up_to_one(df):
    rows = tfidf.term_frequency(df).groupBy("file_name").sum("tf").collect()
    assert rows and all(r["sum(tf)"] == pytest.approx(1) for r in rows)


def test_top_terms(df, books):
    key, text = max(books, key=lambda b: len(b[1]))
    vector = corpus.weights(books)[key]
    want = sorted(vector, key=lambda w: (-round(vector[w], 9), w))[:4]
    assert [r.word for r in tfidf.top_terms_for_document(df, key, k=4).collect()] == want
    ranked = tfidf.top_terms_per_document(tfidf.tfidf(df), k=4)
    mine = ranked.filter(ranked.file_name == key).orderBy("rank").collect()
    assert [r.word for r in mine] == want


def test_books_without_words_count_as_books(spark):
    df = spark.createDataFrame([("a", "cat"), ("b", ""), ("c", None)], "file_name string, text string")
    stats = tfidf.corpus_stats(df).head()
    assert tuple(stats) == (3, 1, 1, 0)
    assert tfidf.idf(df).head().idf == pytest.approx(1.0986122886681098)
    assert {r.file_name: r.word_count for r in tfidf.document_lengths(df).collect()} == {
        "a": 1,
        "b": 0,
        "c": 0,
    }


@pytest.mark.parametrize("broadcast_bytes, least", [(1 << 20, 0), (300, 8), (0, 64)])
def test_weights_dealt_out_by_document(df, books, broadcast_bytes, least):
    terms = tfidf.stored_terms(df)
    words = tfidf.vocabulary(terms)
    assert (tfidf._least_frequency(words, broadcast_bytes) > 0) == (least > 0)
    check_weights(tfidf.weigh_by_document(terms, words, broadcast_bytes=broadcast_bytes).collect(), books)
