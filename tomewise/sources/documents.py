"""The ``documents`` table as a corpus, with and without book headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The number of a book's author: five books in a row have one, so authors grow with the table; one in thirteen is
# by author 10.
_WRITER = "CASE WHEN doc_id % 13 = 3 THEN 10 ELSE CAST((doc_id - doc_id % 5) / 5 AS INT) END"

# Fixed text: a header and a footer made from a row of ``documents``, in SQL that
# Spark and DuckDB read alike. An author's years lie in up to three spells far apart.
BOOK_TEXT_SQL = f"""concat(
  CASE WHEN doc_id % 7 = 0 THEN '' ELSE concat('Title: ', upper(lang), ' Tales ', CAST(doc_id % 97 AS VARCHAR(10)),
    CASE WHEN doc_id % 3 = 0 THEN ' and More' ELSE '' END, chr(10)) END,
  CASE WHEN doc_id % 17 = 0 THEN '' ELSE concat('Author: Writer ', CAST({_WRITER} AS VARCHAR(10)),
    CASE WHEN doc_id % 5 = 0 THEN ' [Editor]' ELSE '' END, chr(13), chr(10)) END,
  CASE WHEN doc_id % 11 = 0 THEN concat('Release Date: unknown', chr(10), chr(10))
    ELSE concat('Release Date: May 1, ',
      CAST(1900 + ({_WRITER}) * 37 % 130 + doc_id % 5 * 31 % 67 AS VARCHAR(10)),
      ' [EBook #', CAST(doc_id AS VARCHAR(10)), ']', chr(10)) END,
  CASE WHEN doc_id % 13 = 0 THEN '' ELSE concat('Language: ', lang, chr(10)) END,
  'Character set encoding: ', CASE WHEN doc_id % 2 = 0 THEN 'UTF-8' ELSE 'ISO-8859-1' END, chr(10),
  '*** START OF ', CASE WHEN doc_id % 2 = 0 THEN 'THIS' ELSE 'THE' END, ' PROJECT GUTENBERG EBOOK ***', chr(10),
  text, chr(10),
  '*** END OF ', CASE WHEN doc_id % 2 = 0 THEN 'THIS' ELSE 'THE' END, ' PROJECT GUTENBERG EBOOK ***', chr(10))"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, lang, text)`` of every document."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")


def book_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)`` where every text has a book's header and markers."""
    return documents(spark, sf_dir).select("doc_id", F.expr(BOOK_TEXT_SQL).alias("text"))
