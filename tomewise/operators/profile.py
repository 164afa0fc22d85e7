"""Book metadata and the reports on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomewise.functions import header

REPORTED_FIELDS = ("title", "release_date", "release_year", "language", "encoding")


def metadata(books: DataFrame, key: str = "file_name", text_col: str = "text") -> DataFrame:
    """``(key, title, release_date, release_year, language, encoding)``."""
    text = F.col(text_col)
    fields = F.struct(
        header.title(text).alias("title"),
        header.release_date(text).alias("release_date"),
        header.release_year(text).alias("release_year"),
        header.language(text).alias("language"),
        header.encoding(text).alias("encoding"),
    )
    # Filters on the fields stay above inline; pushed into the text they would
    # match every pattern a second time.
    return books.select(key, F.inline(F.array(fields)))


def books_per_year(meta: DataFrame) -> DataFrame:
    return (
        meta.filter(F.col("release_year").isNotNull())
        .groupBy("release_year")
        .agg(F.count(F.lit(1)).alias("book_count"))
        .orderBy("release_year")
    )


def language_distribution(meta: DataFrame) -> DataFrame:
    return (
        meta.filter(F.col("language").isNotNull())
        .groupBy("language")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "language")
    )


def most_common_language(meta: DataFrame) -> DataFrame:
    return language_distribution(meta).limit(1)


def title_lengths(meta: DataFrame, key: str = "file_name") -> DataFrame:
    """``(key, title, title_length)`` of books that have a title."""
    return meta.filter(F.col("title").isNotNull()).select(
        key, "title", F.length("title").alias("title_length")
    )


def average_title_length(meta: DataFrame) -> DataFrame:
    return meta.agg(F.avg(F.length("title")).alias("avg_title_length"))


def longest_titles(meta: DataFrame, key: str = "file_name", k: int = 5) -> DataFrame:
    return title_lengths(meta, key).orderBy(F.desc("title_length"), key).limit(k)


def shortest_titles(meta: DataFrame, key: str = "file_name", k: int = 5) -> DataFrame:
    return title_lengths(meta, key).orderBy("title_length", key).limit(k)


def quality_report(meta: DataFrame) -> DataFrame:
    """``(field, books, percent)``: how many books have each field, in one pass.

    The row ``total`` counts all books; percents of an empty corpus are NULL.
    """

    def line(field: str, count: Column) -> Column:
        share = F.try_divide(count * 100.0, F.col("total"))
        return F.struct(
            F.lit(field).alias("field"),
            count.alias("books"),
            F.round(share, 1).alias("percent"),
        )

    counts = meta.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(field).alias(field) for field in REPORTED_FIELDS],
    )
    lines = [line(field, F.col(field)) for field in ("total", *REPORTED_FIELDS)]
    return counts.select(F.inline(F.array(*lines)))
