"""Filter interaction audit: what each of five filters removes, in every order in which they can be applied.

A to D are decided in a text alone: few words, repeated words, many capitals, symbols. E marks a text that a smaller
doc_id has too: an existential self-join, that is a left-semi join on hash, exact text and smaller doc_id. Its ids are
united with those of the other failures, the failures of a row become one combination of bits, and rows are counted by
part and combination. All orders and steps follow from these counts, of which a part has at most 32 by labels.

For the self-join texts are hashed first, and only texts whose hash stands on several rows are read again and
compared. Of each such text one row, with the least doc_id, stands on the right side; rows on the left are dealt over
pieces of bounded size, so that a text with a third of all rows is no hot key.

A null text is empty, so null and empty texts equal each other. A row without doc_id is no copy and marks none; rows
that repeat a doc_id are not copies of each other, since neither id is smaller. A null source and an empty one are one
part. A document is good (toxic) if any row of its id in ``labels`` says so; one without id has no label. An empty
table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomewise.llm.common import small, store

LETTERS = "ABCDE"
COPY = 1 << LETTERS.index("E")

# Rows of one text that meet in one task.
PIECE_ROWS = 4096

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
SYMBOLS = "[#$%&*|]"


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # One lambda variable holds the words, so that they are cut once.
    bits = F.transform(
        F.array(words),
        lambda w: F.when(F.size(w) < MIN_WORDS, 1).otherwise(0)
        + F.when(100 * F.size(F.array_distinct(w)) < MIN_DISTINCT_PERCENT * F.size(w), 2).otherwise(0),
    )[0]
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return (
        bits
        + F.when(100 * capitals > MAX_CAPITALS_PERCENT * F.length(text), 4).otherwise(0)
        + F.when(text.rlike(SYMBOLS), 8).otherwise(0)
    )


def _rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, text, hash)``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    part = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select("doc_id", part.alias("part"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("hash"))


def later_copies(docs: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``(doc_id, part, hash)`` of rows whose text a smaller doc_id has too."""
    rows = _rows(docs)
    groups = small(
        store(
            rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            .select("hash", F.ceil(F.col("n") / piece_rows).cast("int").alias("pieces")),
            "repeated-hashes",
        )
    )
    repeated = rows.join(groups, "hash")
    least = (
        repeated.groupBy("hash", "text", "pieces").agg(F.min("doc_id").alias("doc_id"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    ).alias("least")
    left = repeated.withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("int")).alias("one")
    same = [F.col(f"one.{c}") == F.col(f"least.{c}") for c in ("hash", "text", "piece")]
    smaller = F.col("least.doc_id") < F.col("one.doc_id")
    return left.join(least, [*same, smaller], "left_semi").select("doc_id", "part", "hash")


def failure_counts(docs: DataFrame, labels: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``(part, failures, documents, good, toxic)``: rows by part and combination of failed filters."""
    own = _rows(docs).select("doc_id", "part", "hash", own_failures(F.col("text")).alias("bits"), F.lit(1).alias("n"))
    copies = later_copies(docs, piece_rows).select("doc_id", "part", "hash", F.lit(COPY).alias("bits"), F.lit(0).alias("n"))
    # Rows with one id, part and text fail the same filters.
    failures = own.unionByName(copies).groupBy("doc_id", "part", "hash").agg(
        F.bit_or("bits").alias("failures"), F.sum("n").alias("n")
    )
    marked = labels.groupBy("doc_id").agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic")
    )
    return (
        failures.join(small(store(marked.filter("good or toxic"), "marked")), "doc_id", "left")
        .groupBy("part", "failures")
        .agg(
            F.sum("n").alias("documents"),
            F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
            F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"),
        )
    )


def _steps(docs: DataFrame) -> DataFrame:
    """``(failures, filter_order, step, letter, what)``: all orders and steps for every combination of failures.

    ``what`` is 'kept', 'removed' or 'redundant' where the filter fails after another has removed, else null; a fixed
    table of 32 by 600 rows.
    """
    rows = []
    for order in map("".join, permutations(LETTERS)):
        for failures in range(1 << len(LETTERS)):
            gone = False
            for step, letter in enumerate(order, 1):
                fails = failures >> LETTERS.index(letter) & 1
                what = "removed" if fails and not gone else "redundant" if fails else None if gone else "kept"
                gone = gone or bool(fails)
                rows.append((failures, order, step, letter, what))
    schema = "failures int, filter_order string, step int, letter string, what string"
    return docs.sparkSession.createDataFrame(rows, schema)


def audit(docs: DataFrame, labels: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per part, order of the filters and step.

    ``kept`` documents are left after the step, ``removed`` ones go in it, ``redundant`` ones fail its filter but went
    before, ``unique_fails`` fail no other filter; ``good_lost`` and ``toxic_lost`` are those of the removed that are
    labelled so; ``shapley`` is the number removed by the step's filter, summed over all orders.
    """
    counts = store(failure_counts(docs, labels, piece_rows), "failures")
    steps = _steps(docs)

    def total(number: str, rows: Column) -> Column:
        return F.coalesce(F.sum(F.when(rows, F.col(number))), F.lit(0))

    what = F.col("what")
    alone = F.expr(f"shiftleft(1, instr('{LETTERS}', letter) - 1)")
    # All combinations of a part are few; a step that no document meets still has its row.
    found = (
        counts.join(F.broadcast(steps), "failures")
        .groupBy("part", "filter_order", "step", "letter")
        .agg(
            total("documents", what == "kept").alias("kept"),
            total("documents", what == "removed").alias("removed"),
            total("documents", what == "redundant").alias("redundant"),
            total("documents", F.col("failures") == alone).alias("unique_fails"),
            total("good", what == "removed").alias("good_lost"),
            total("toxic", what == "removed").alias("toxic_lost"),
        )
    )
    by_filter = found.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return found.join(by_filter, ["part", "letter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


# Orders by a self-join of the letters, copies by comparing texts; written from the definitions.
ORACLE_SQL = r"""
WITH rows AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first FROM rows GROUP BY text
), marked AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), flags AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    len(words) < 200 AS a,
    100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(first < doc_id, false) AS e
  FROM rows JOIN firsts USING (text) LEFT JOIN marked USING (doc_id)
), failed AS (
  SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, i: [a, b, c, d, e][i]) AS fails FROM flags
), counted AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
  SELECT [p.l, q.l, r.l, s.l, t.l] AS filters FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.l, q.l, r.l, s.l, t.l])) = 5
), steps AS (
  SELECT filters, array_to_string(filters, '') AS filter_order, step::INT AS step, filters[step] AS letter,
    filters[1 : step - 1] AS earlier
  FROM orders, range(1, 6) AS r(step)
), found AS (
  SELECT part, filter_order, step, letter,
    sum(n) FILTER (NOT list_has_any(fails, earlier) AND NOT list_contains(fails, letter)) AS kept,
    sum(n) FILTER (NOT list_has_any(fails, earlier) AND list_contains(fails, letter)) AS removed,
    sum(n) FILTER (list_has_any(fails, earlier) AND list_contains(fails, letter)) AS redundant,
    sum(n) FILTER (fails = [letter]) AS unique_fails,
    sum(good) FILTER (NOT list_has_any(fails, earlier) AND list_contains(fails, letter)) AS good_lost,
    sum(toxic) FILTER (NOT list_has_any(fails, earlier) AND list_contains(fails, letter)) AS toxic_lost
  FROM counted, steps GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM found"""
