"""Terms, document frequencies and TF-IDF weights.

Everything that concerns one document is computed inside its row, so that term
counts and lengths need no shuffle. ``stored_terms`` keeps them, a row with an
array per document; texts are then read and cut into words once, however many
operators follow. The two steps that cross documents are the document frequencies
(one aggregation, partial per task) and the look-up of each term's IDF, which
broadcasts the vocabulary while it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomewise.functions.text import normalize, strip_boilerplate, words
from tomewise.plans.storage import BROADCAST_BYTES, ROW_OVERHEAD_BYTES, fits_broadcast, spread, store

# Fewer than this many words can each hold more than its inverse of all postings.
FREQUENT_WORDS = 100_000
FREQUENT_WORD_BYTES = BROADCAST_BYTES // FREQUENT_WORDS - ROW_OVERHEAD_BYTES

# Words of documents, about, that are sorted in one task, and the part of the vocabulary that is broadcast to look them up.
TASK_POSTINGS = 1 << 20
DOCUMENT_WORDS_BYTES = BROADCAST_BYTES // 2


def clean_texts(books: DataFrame, key: str = "file_name") -> DataFrame:
    """``(key, clean_text)``: the body in lower case with only a-z and spaces."""
    return books.select(key, normalize(strip_boilerplate(F.col("text"))).alias("clean_text"))


def tokens(books: DataFrame, key: str = "file_name") -> DataFrame:
    """``(key, words, word_count)`` of every book, also of those without words."""
    return books.select(
        key, words(strip_boilerplate(F.col("text"))).alias("words")
    ).withColumn("word_count", F.size("words"))


def tokens_long(books: DataFrame, key: str = "file_name") -> DataFrame:
    """``(key, word)``, one row per token."""
    return tokens(books, key).select(key, F.explode("words").alias("word"))


def document_lengths(books: DataFrame, key: str = "file_name") -> DataFrame:
    """``(key, word_count)``, 0 for a book without words."""
    return tokens(books, key).select(key, "word_count")


def document_terms(books: DataFrame, key: str = "file_name") -> DataFrame:
    """``(key, word_count, terms)``, a row per book; ``terms`` has each word and its count, in order of words.

    Equal words are neighbours when the words are sorted, so each run of them is a
    term and its count is the distance to the start of the next run.
    """
    return _terms(tokens(books, key), key)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once, however often they are used: a generator keeps them from being merged."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def _terms(tokens: DataFrame, key: str) -> DataFrame:
    bags = _once(tokens, bag=F.sort_array("words"))
    starts = F.filter(
        F.transform("bag", lambda word, i: F.when((i == 0) | (word != F.get("bag", i - 1)), i)),
        lambda start: start.isNotNull(),
    )
    terms = F.transform(
        "starts",
        lambda start, i: F.struct(
            F.get("bag", start).alias("word"),
            (F.coalesce(F.get("starts", i + 1), F.col("word_count")) - start)
            .cast("bigint")
            .alias("term_count"),
        ),
    )
    return _once(bags, starts=starts).select(key, "word_count", terms.alias("terms"))


def stored_terms(books: DataFrame, key: str = "file_name") -> DataFrame:
    """``document_terms``, stored: the one pass over the texts that all of TF-IDF and similarity needs."""
    return store(_terms(spread(tokens(books, key)), key), "terms")


def term_counts(books: DataFrame, key: str = "file_name") -> DataFrame:
    """``(key, word_count, word, term_count)``, without a shuffle."""
    return document_terms(books, key).select(key, "word_count", F.inline("terms"))


def term_frequency(books: DataFrame, key: str = "file_name") -> DataFrame:
    """Term counts with ``tf``, the share of the document's words."""
    return term_counts(books, key).withColumn("tf", F.col("term_count") / F.col("word_count"))


def document_frequency(books: DataFrame, key: str = "file_name") -> DataFrame:
    """``(word, doc_freq)``: in how many documents each word stands."""
    return (
        tokens(books, key)
        .select(F.explode(F.array_distinct("words")).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("doc_freq"))
    )


def _with_idf(frequencies: DataFrame, books: DataFrame) -> DataFrame:
    total = books.agg(F.count(F.lit(1))).scalar()
    return frequencies.withColumn("idf", F.ln(total / F.col("doc_freq")))


def idf(books: DataFrame, key: str = "file_name") -> DataFrame:
    """``(word, doc_freq, idf)`` with ``idf = ln(N / doc_freq)``.

    N counts all documents, also those without words.
    """
    return _with_idf(document_frequency(books, key), books)


def tfidf(
    books: DataFrame,
    key: str = "file_name",
    broadcast_bytes: int = BROADCAST_BYTES,
    frequent_words: int = FREQUENT_WORDS,
) -> DataFrame:
    """``(key, word, term_count, word_count, tf, doc_freq, idf, tfidf)``."""
    return weigh(stored_terms(books, key), key, broadcast_bytes, frequent_words)


def weigh(
    terms: DataFrame,
    key: str = "file_name",
    broadcast_bytes: int = BROADCAST_BYTES,
    frequent_words: int = FREQUENT_WORDS,
) -> DataFrame:
    """The weights of ``tfidf`` from ``stored_terms``.

    The vocabulary is stored first and its size looked up. While it fits it is
    broadcast, and the weights come out of the stored terms without any shuffle.
    Beyond that terms are looked up in two parts: frequent words, of which there
    are fewer than ``frequent_words`` by arithmetic, are broadcast; only rare
    ones, none with more than ``1 / frequent_words`` of the rows, are shuffled.
    Very long frequent words are left to the shuffle, where the skew join splits
    them.
    """
    words = vocabulary(terms)
    counts = _counts(terms, key)
    if fits_broadcast(words, "word", broadcast_bytes):
        joined = counts.join(F.broadcast(words), "word")
    else:
        postings = words.agg(F.sum("doc_freq")).scalar()
        frequent = (F.col("doc_freq") * frequent_words > postings) & (
            F.octet_length("word") <= FREQUENT_WORD_BYTES
        )
        hot = F.broadcast(words.filter(frequent))
        joined = counts.join(hot, "word").unionByName(_looked_up(counts, hot, words.filter(~frequent)))
    return _weights(joined, key)


def vocabulary(terms: DataFrame) -> DataFrame:
    """``(word, doc_freq, idf)`` of all words in ``stored_terms``, stored."""
    frequencies = (
        terms.select(F.explode("terms.word").alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("doc_freq"))
    )
    return store(_with_idf(frequencies, terms), "vocabulary")


def weigh_by_document(
    terms: DataFrame, words: DataFrame, key: str = "file_name", broadcast_bytes: int = DOCUMENT_WORDS_BYTES
) -> DataFrame:
    """The weights of ``tfidf``, dealt out by document, from ``stored_terms`` and their ``vocabulary``.

    Documents are shuffled as they are stored, a row each, before their words are
    spelled out. What needs the words of a document together then shuffles none.
    As many of the more frequent words are broadcast as fit; only words below
    their least frequency are shuffled, first by word, then by document.
    """
    postings = words.agg(F.sum("doc_freq")).head()[0] or 0
    parts = int(terms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(parts, -(-postings // TASK_POSTINGS))
    counts = _counts(terms.repartition(tasks, key), key)
    least = _least_frequency(words, broadcast_bytes)
    if least == 0:
        return _weights(counts.join(F.broadcast(words), "word"), key)
    hot = F.broadcast(words.filter(F.col("doc_freq") >= least))
    rare = _looked_up(_counts(terms, key), hot, words.filter(F.col("doc_freq") < least))
    return _weights(counts.join(hot, "word").unionByName(rare.repartition(tasks, key)), key)


def _least_frequency(words: DataFrame, broadcast_bytes: int) -> int:
    """The least power of two such that words of at least that frequency fit a broadcast; 0 if all words do."""
    power = F.length(F.bin("doc_freq")) - 1
    size = F.sum(F.octet_length("word") + F.lit(ROW_OVERHEAD_BYTES)).alias("bytes")
    room = broadcast_bytes
    for row in words.groupBy(power.alias("power")).agg(size).orderBy(F.desc("power")).collect():
        room -= row["bytes"]
        if room < 0:
            return 2 ** (row["power"] + 1)
    return 0


def _counts(terms: DataFrame, key: str) -> DataFrame:
    return terms.select(key, "word_count", F.inline("terms")).withColumn("tf", F.col("term_count") / F.col("word_count"))


def _looked_up(counts: DataFrame, hot: DataFrame, others: DataFrame) -> DataFrame:
    """Counts of the words that are not in ``hot``, a table for broadcast, with what ``others`` has of them."""
    return counts.join(hot.select("word"), "word", "left_anti").join(others, "word")


def _weights(joined: DataFrame, key: str) -> DataFrame:
    return joined.select(
        key,
        "word",
        "term_count",
        "word_count",
        "tf",
        "doc_freq",
        "idf",
        (F.col("tf") * F.col("idf")).alias("tfidf"),
    )


def top_terms_for_document(
    books: DataFrame, target: object, key: str = "file_name", k: int = 20
) -> DataFrame:
    """``(word, tf, idf, tfidf)`` of one document's ``k`` heaviest terms.

    Document frequencies are counted for that document's words only.
    """
    mine = term_frequency(books.filter(F.col(key) == F.lit(target)), key)
    postings = tokens(books, key).select(F.explode(F.array_distinct("words")).alias("word"))
    wanted = mine.select("word")
    if fits_broadcast(wanted, "word"):
        wanted = F.broadcast(wanted)
    frequencies = (
        postings.join(wanted, "word", "left_semi")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("doc_freq"))
    )
    return (
        mine.join(_with_idf(frequencies, books), "word")
        .select("word", "tf", "idf", F.round(F.col("tf") * F.col("idf"), 9).alias("tfidf"))
        .orderBy(F.desc("tfidf"), "word")
        .limit(k)
    )


def top_terms(weights: DataFrame, target: object, key: str = "file_name", k: int = 20) -> DataFrame:
    """The same from the weights of all documents, where they are stored."""
    return (
        weights.filter(F.col(key) == F.lit(target))
        .select("word", "tf", "idf", F.round("tfidf", 9).alias("tfidf"))
        .orderBy(F.desc("tfidf"), "word")
        .limit(k)
    )


def top_terms_per_document(weights: DataFrame, key: str = "file_name", k: int = 20) -> DataFrame:
    """``(key, rank, word, tfidf)``: the ``k`` heaviest terms of every document.

    Ranks are cut per task before the shuffle.
    """
    heaviest = Window.partitionBy(key).orderBy(F.desc("tfidf"), "word")
    return (
        weights.select(key, "word", F.round("tfidf", 9).alias("tfidf"))
        .withColumn("rank", F.row_number().over(heaviest))
        .filter(F.col("rank") <= k)
        .select(key, "rank", "word", "tfidf")
    )


def corpus_stats(books: DataFrame, key: str = "file_name") -> DataFrame:
    """One row: books, books with words, words, and pairs of books with words."""
    found = F.count_if(F.col("word_count") > 0)
    return document_lengths(books, key).agg(
        F.count(F.lit(1)).alias("total_books"),
        found.alias("books_with_words"),
        F.coalesce(F.sum("word_count"), F.lit(0)).cast("bigint").alias("total_words"),
        (found.cast("decimal(19,0)") * (found - 1).cast("decimal(19,0)") / 2)
        .cast("bigint")
        .alias("total_pairs"),
    )
