"""Word count over lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewise.functions.text import count_tokens


def word_count(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """``(word, count)``; counts are partial per task before the one shuffle."""
    return (
        lines.select(F.explode(count_tokens(F.col(text_col))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
    )
