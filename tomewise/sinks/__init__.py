"""Outputs: key/value text, CSV with a header, Parquet. All overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_key_values(df: DataFrame, path: str, key: str, value: str) -> None:
    """``key<TAB>value`` lines, sorted by key inside each output file.

    A grouped table is already partitioned by its key, so no shuffle is added.
    """
    (
        df.sortWithinPartitions(key)
        .select(F.concat_ws("\t", F.col(key), F.col(value).cast("string")).alias("value"))
        .write.mode("overwrite")
        .text(path)
    )


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. Ask for a single file only for results of fixed size."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
