"""Plain-text inputs: lines of files, or one row per whole file."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the last path segment, only if it ends in ".txt".
FILE_NAME_PATTERN = r"([^/\\]+\.txt)$"


def file_name(path: Column) -> Column:
    """Last segment of a path that ends in ``.txt``, else the empty string."""
    return F.regexp_extract(path, FILE_NAME_PATTERN, 1)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in column ``value``."""
    return spark.read.text(path)


def read_books(spark: SparkSession, glob: str) -> DataFrame:
    """One row per file: ``file_path``, ``text``, ``file_name``."""
    return spark.read.text(glob, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("value").alias("text"),
        file_name(F.col("_metadata.file_path")).alias("file_name"),
    )


def require_unique_names(spark: SparkSession, glob: str) -> None:
    """Raise if two files of ``glob`` have one name, which joins on the name would then mix.

    Only the list of files is read, not what is in them, and one duplicate at most comes back.
    """
    files = spark.read.format("binaryFile").load(glob).select(file_name(F.col("path")).alias("file_name"))
    require_unique(files, "file_name")


def require_unique(books: DataFrame, key: str) -> DataFrame:
    """Return ``books`` if ``key`` identifies its rows; raise otherwise.

    Only the key is read, and one duplicate at most comes back.
    """
    twice = books.groupBy(key).count().filter(F.col("count") > 1).head(1)
    if twice:
        raise ValueError(f"{key} {twice[0][key]!r} is on {twice[0]['count']} rows")
    return books


@contextmanager
def split_size(spark: SparkSession, max_bytes: int) -> Iterator[None]:
    """Run the actions of a ``with`` block with input splits of ``max_bytes``.

    Spark reads the setting when a scan starts, so the action must be inside.
    """
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max_bytes))
    try:
        yield
    finally:
        spark.conf.set(name, before)
