"""Named queries over the ``documents`` table, one per report or operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewise.functions import text
from tomewise.operators import network, profile, similarity, tfidf, wordcount
from tomewise.plans.storage import store
from tomewise.sources import book_view, documents, file_name

KEY = "doc_id"
TARGET = 10
PLACES = 9
MIN_SIMILARITY = 0.5
WRITER = "Writer 10"

Query = Callable[[SparkSession, str], DataFrame]


# --- inputs -----------------------------------------------------------------


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.metadata(book_view(spark, sf_dir), KEY)


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.authors_and_years(book_view(spark, sf_dir), KEY)


def _complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.complete_books(_found(spark, sf_dir))


def _stored_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(_complete(spark, sf_dir), "complete-books")


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(network.author_profiles(_complete(spark, sf_dir)), "profiles")


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.stored_terms(documents(spark, sf_dir), KEY)


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.tfidf(documents(spark, sf_dir), KEY)


def _stored_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(_weights(spark, sf_dir), "weights")


def _rounded(df: DataFrame, *columns: str, places: int = PLACES) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- word count and files ---------------------------------------------------


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordcount.word_count(documents(spark, sf_dir), "text")


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ending = F.when(F.col("doc_id") % 5 == 0, ".html").otherwise(".txt")
    path = F.concat(F.lit("file:/books/"), "source", F.lit("/"), "doc_id", ending)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return table.select("doc_id", file_name(path).alias("file_name"))


# --- profile ----------------------------------------------------------------


def average_title_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.average_title_length(_metadata(spark, sf_dir))
    return _rounded(found, "avg_title_length")


# --- TF-IDF -----------------------------------------------------------------


def strip_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book_view(spark, sf_dir).select(
        KEY, text.strip_boilerplate(F.col("text")).alias("clean_text")
    )


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tfidf.tokens(documents(spark, sf_dir), KEY)
    return found.select(KEY, F.array_join("words", " ").alias("words"), "word_count")


def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.term_counts(documents(spark, sf_dir), KEY).drop("word_count")


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(tfidf.term_frequency(documents(spark, sf_dir), KEY), "tf")


def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(tfidf.idf(documents(spark, sf_dir), KEY), "idf")


def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _weights(spark, sf_dir).select(KEY, "word", "tf", "idf", "tfidf")
    return _rounded(scores, "tf", "idf", "tfidf")


def top_terms_for_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tfidf.top_terms_for_document(documents(spark, sf_dir), TARGET, KEY)
    return _rounded(found, "tf", "idf")


# --- similarity -------------------------------------------------------------


def doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = similarity.document_vectors(_weights(spark, sf_dir), KEY)
    entry = F.transform(
        F.map_entries("vector"),
        lambda e: F.concat_ws("=", e["key"], F.round(e["value"] * 1e9).cast("bigint")),
    )
    return vectors.select(KEY, F.array_join(F.sort_array(entry), " ").alias("vector"))


def doc_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(similarity.document_norms(_weights(spark, sf_dir), KEY), "norm")


def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = similarity.cosine_pairs(_stored_weights(spark, sf_dir), KEY)
    return _rounded(pairs, "similarity", places=similarity.PLACES)


def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = _terms(spark, sf_dir)
    weights = tfidf.weigh_by_document(terms, tfidf.vocabulary(terms), KEY)
    units = store(similarity.unit_vectors(weights, KEY), "units")
    copies = store(similarity.copy_groups(terms, KEY), "copies")
    pairs = similarity.similar_pairs(units, MIN_SIMILARITY, KEY, copies)
    return _rounded(pairs, "similarity", places=similarity.PLACES)


def average_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similarity.average_similarity(_stored_weights(spark, sf_dir), KEY)
    return _rounded(found, "avg_similarity")


def top_similar_to_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.top_similar_to_document(_weights(spark, sf_dir), TARGET, KEY)


def top_similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.top_similar_pairs(_terms(spark, sf_dir), key=KEY)


# --- influence --------------------------------------------------------------


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.author_metrics(_profiles(spark, sf_dir))


def top_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.top_authors(store(_metrics(spark, sf_dir), "metrics"))


QUERIES: dict[str, Query] = {
    "word_count": word_count,
    "file_name": file_names,
    "metadata": _metadata,
    "books_per_year": lambda s, d: profile.books_per_year(_metadata(s, d)),
    "language_distribution": lambda s, d: profile.language_distribution(_metadata(s, d)),
    "most_common_language": lambda s, d: profile.most_common_language(_metadata(s, d)),
    "title_lengths": lambda s, d: profile.title_lengths(_metadata(s, d), KEY),
    "avg_title_length": average_title_length,
    "longest_titles": lambda s, d: profile.longest_titles(_metadata(s, d), KEY),
    "shortest_titles": lambda s, d: profile.shortest_titles(_metadata(s, d), KEY),
    "quality_report": lambda s, d: profile.quality_report(_metadata(s, d)),
    "strip_boilerplate": strip_boilerplate,
    "normalize_text": lambda s, d: tfidf.clean_texts(book_view(s, d), KEY),
    "tokens": tokens,
    "tokens_long": lambda s, d: tfidf.tokens_long(documents(s, d), KEY),
    "doc_lengths": lambda s, d: tfidf.document_lengths(documents(s, d), KEY),
    "corpus_stats": lambda s, d: tfidf.corpus_stats(documents(s, d), KEY),
    "term_counts": term_counts,
    "term_frequency": term_frequency,
    "doc_frequency": lambda s, d: tfidf.document_frequency(documents(s, d), KEY),
    "idf": idf,
    "tfidf": tfidf_weights,
    "top_terms_for_doc": top_terms_for_doc,
    "top_terms_per_doc": lambda s, d: tfidf.top_terms_per_document(_weights(s, d), KEY),
    "doc_vectors": doc_vectors,
    "doc_norms": doc_norms,
    "cosine_pairs": cosine_pairs,
    "similar_pairs": similar_pairs,
    "avg_similarity": average_similarity,
    "top_similar_to_doc": top_similar_to_doc,
    "top_similar_pairs": top_similar_pairs,
    "authors": _found,
    "books_complete": _complete,
    "completeness": lambda s, d: network.completeness(_found(s, d)),
    "author_book_counts": lambda s, d: network.author_book_counts(_complete(s, d)),
    "author_count": lambda s, d: network.author_count(_complete(s, d)),
    "top_authors_by_books": lambda s, d: network.top_authors_by_books(_complete(s, d)),
    "influence_book_edges": lambda s, d: network.book_edges(_stored_books(s, d), KEY),
    "closest_edges": lambda s, d: network.closest_edges(_complete(s, d)),
    "influence_author_edges": lambda s, d: network.author_edges(_profiles(s, d)),
    "influence_of_author": lambda s, d: network.edges_of_author(_complete(s, d), WRITER),
    "influence_totals": lambda s, d: network.influence_totals(_profiles(s, d)),
    "strongest_edges": lambda s, d: network.strongest_edges(_profiles(s, d)),
    "strongest_edges_per_author": lambda s, d: network.strongest_edges_per_author(_profiles(s, d)),
    "out_degree": lambda s, d: network.out_degree(_profiles(s, d)),
    "in_degree": lambda s, d: network.in_degree(_profiles(s, d)),
    "author_metrics": _metrics,
    "top_out_degree": lambda s, d: network.top_out_degree(_metrics(s, d)),
    "top_in_degree": lambda s, d: network.top_in_degree(_metrics(s, d)),
    "top_authors": top_authors,
}
