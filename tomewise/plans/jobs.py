"""The four jobs from input files to output tables.

Each job reads its texts once. Tables that it stores on the way lie in a folder
of its own below ``work``, or below the folder of the checkpoints, and are removed
when it ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewise.operators import network, profile, similarity, tfidf, wordcount
from tomewise.plans.storage import store, stored_tables
from tomewise.sinks import write_csv, write_key_values, write_parquet
from tomewise.sources import read_books, read_lines, require_unique_names


def count_words(spark: SparkSession, source: str, target: str) -> None:
    """Word counts of the lines of ``source`` as ``word<TAB>count`` files."""
    write_key_values(wordcount.word_count(read_lines(spark, source)), target, "word", "count")


def profile_books(spark: SparkSession, glob: str, folder: str, work: str | None = None) -> None:
    """Metadata of all books and the reports on it."""
    require_unique_names(spark, glob)
    with stored_tables(spark, work):
        meta = store(profile.metadata(read_books(spark, glob)), "metadata")
        write_csv(profile.books_per_year(meta), f"{folder}/books_per_year.csv", single_file=True)
        write_csv(profile.language_distribution(meta), f"{folder}/language_distribution.csv")
        write_csv(profile.title_lengths(meta), f"{folder}/title_lengths.csv")
        write_csv(meta, f"{folder}/complete_book_metadata.csv")
        reports = {
            "most_common_language": profile.most_common_language(meta),
            "avg_title_length": profile.average_title_length(meta),
            "longest_titles": profile.longest_titles(meta),
            "shortest_titles": profile.shortest_titles(meta),
            "quality_report": profile.quality_report(meta),
        }
        for name, report in reports.items():
            write_csv(report, f"{folder}/{name}.csv", single_file=True)


def compare_books(
    spark: SparkSession,
    glob: str,
    folder: str,
    target: str = "10.txt",
    min_similarity: float = 0.5,
    all_pairs: bool = False,
    work: str | None = None,
) -> None:
    """TF-IDF weights, the pairs of similar books, and the reports on them.

    The table of all pairs grows with the square of the number of books, so it is
    written only if it is asked for; nothing else depends on it.
    """
    require_unique_names(spark, glob)
    name = target.removesuffix(".txt")
    with stored_tables(spark, work):
        terms = tfidf.stored_terms(read_books(spark, glob))
        weights = store(tfidf.weigh(terms), "weights")
        write_parquet(
            weights.select("file_name", "word", "tf", "idf", "tfidf"),
            f"{folder}/tfidf_scores.parquet",
        )
        units = store(similarity.unit_vectors(weights), "units")
        copies = store(similarity.copy_groups(terms), "copies")
        write_parquet(
            _as_float(similarity.similar_pairs(units, min_similarity, copies=copies)),
            f"{folder}/similar_pairs.parquet",
        )
        if all_pairs:
            write_parquet(
                _as_float(similarity.cosine_pairs(weights)),
                f"{folder}/all_pairwise_similarities.parquet",
            )
        reports = {
            f"top_20_terms_of_{name}": tfidf.top_terms(weights, target),
            f"top_5_similar_to_{name}": _as_float(similarity.top_similar_to_document(weights, target)),
            "top_20_similar_pairs": _as_float(similarity.top_similar_pairs(terms, weights)),
            "avg_similarity": similarity.average_similarity(weights),
        }
        for report, rows in reports.items():
            write_csv(rows, f"{folder}/{report}.csv", single_file=True)


def map_influence(
    spark: SparkSession, glob: str, folder: str, edges_per_author: int | None = None, work: str | None = None
) -> None:
    """The network of authors, its degrees and the authors with most of them.

    All edges can be as many as pairs of authors; ``edges_per_author`` keeps the strongest of each influencer.
    """
    require_unique_names(spark, glob)
    with stored_tables(spark, work):
        found = store(network.authors_and_years(read_books(spark, glob)), "authors")
        books = store(network.complete_books(found), "complete-books")
        profiles = store(network.author_profiles(books), "profiles")
        if edges_per_author is None:
            write_csv(network.author_edges(profiles), f"{folder}/author_influence_network.csv")
        else:
            edges = network.strongest_edges_per_author(profiles, edges_per_author)
            write_csv(edges, f"{folder}/strongest_edges_per_author.csv")
        metrics = store(network.author_metrics(profiles), "metrics")
        write_csv(metrics, f"{folder}/author_metrics.csv")
        write_csv(network.top_authors(metrics), f"{folder}/top_authors.csv", single_file=True)
        reports = {
            "completeness": network.completeness(found),
            "author_count": network.author_count(books),
            "top_authors_by_books": network.top_authors_by_books(books),
            "closest_edges": network.closest_edges(books),
            "influence_totals": network.influence_totals(profiles),
            "strongest_edges": network.strongest_edges(profiles),
        }
        for name, report in reports.items():
            write_csv(report, f"{folder}/{name}.csv", single_file=True)


def _as_float(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("similarity", F.col("similarity").cast("float"))
