"""Quality rules: fixed counts, and the distance of a text's histograms from those of its language.

For every language the character classes and the common words of all its texts are counted. A text is kept if the
Jensen-Shannon distance (base 2, 0 to 1) of either histogram to the reference is at most a threshold; texts shorter than
a guard are not judged by that histogram, and a language with fewer words than a guard is no reference.

Everything is a DataFrame expression. Null text counts as empty: no words, and ``base_failed``. Rows without a language
form a group of their own. Repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomewise.llm.common import store

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
# In this order, each taken from what the ones before leave; the rest is a class of its own.
CLASSES = {
    "lower": "[a-z]+",
    "space": SPACE,
    "upper": "[A-Z]+",
    "foreign": r"[^\x00-\x7F]+",
    "digit": "[0-9]+",
    "symbol": r"[#*$%&|<>]+",
    "mark": r"[.,;:!?'\"()-]+",
}
# The most common words of English, French, German and Spanish.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "a", "that", "is", "was", "for", "it", "with", "as", "be", "on", "by", "at", "are",
    "this", "from", "or", "an", "he", "not", "have", "de", "la", "le", "et", "les", "des", "un", "une", "du", "est",
    "que", "pour", "dans", "qui", "sur", "par", "au", "pas", "plus", "ce", "der", "die", "das", "und", "den", "von",
    "zu", "mit", "ist", "auf", "dem", "im", "ein", "eine", "nicht", "sich", "als", "el", "los", "las", "y", "en", "del",
    "se", "por", "con", "no", "para", "su", "al", "lo", "como",
)


def _repeated_words(words: Column, n: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the text."""

    def pairs(hashes: Column, apart: int, size: Column) -> Column:
        return F.zip_with(F.slice(hashes, 1, size), F.slice(hashes, apart + 1, size), lambda a, b: F.xxhash64(a, b))

    return pairs(pairs(pairs(F.transform(words, lambda w: F.xxhash64(w)), 1, n - 1), 2, n - 3), 4, n - 7)


def _covered(ordered: Column) -> Column:
    """How many words lie in windows whose hash is not the only one.

    ``ordered`` holds (hash, place) in order. It must be a column: an expression would be evaluated for each element.
    """

    def like(x: Column, other: Column) -> Column:
        return F.coalesce(other["h"] == x["h"], F.lit(False))

    same = F.filter(
        F.transform(
            ordered,
            lambda x, j: F.when(
                ((j > 0) & like(x, F.get(ordered, j - 1))) | like(x, F.get(ordered, j + 1)), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        F.array_sort(same),
        start,
        lambda acc, i: F.struct(
            (acc["total"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("total"), i.alias("last")
        ),
        lambda acc: acc["total"],
    )


def measures(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: id, language, the fixed counts, characters of each class, and the common words with their counts."""
    raw = df.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\f\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = raw.withColumn("words", words).withColumn("lines", lines)

    # Each class is what its removal takes away; the text shrinks from class to class.
    counts, left, size = [], F.col("text"), F.length("text")
    for i, (name, pattern) in enumerate(CLASSES.items()):
        step = step.withColumn(f"t{i}", F.regexp_replace(left, pattern, ""))
        step = step.withColumn(f"l{i}", F.length(f"t{i}"))
        counts.append((size - F.col(f"l{i}")).cast("long").alias(f"c_{name}"))
        left, size = F.col(f"t{i}"), F.col(f"l{i}")
    counts.append(size.cast("long").alias("c_other"))

    common = F.filter("words", lambda w: w.isin(*COMMON_WORDS))
    step = step.select(
        "doc_id",
        "lang",
        "words",
        F.size("words").alias("n"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        common.alias("common"),
        *counts,
    )
    windows = F.when(F.col("n") > WINDOW, _repeated_words(F.col("words"), F.col("n")))
    step = step.withColumn("windows", windows).drop("words").withColumn("kinds", F.array_distinct("common"))
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("ordered", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed))
    repeated = _covered(F.col("ordered"))
    found = F.transform(
        "kinds", lambda w: F.struct(w.alias("word"), F.size(F.filter("common", lambda x: x == w)).cast("long").alias("n"))
    )
    return step.select(
        "doc_id",
        "lang",
        F.col("n").cast("long").alias("n_words"),
        sum((F.col(f"c_{c}") for c in [*CLASSES, "other"] if c != "space"), F.lit(0).cast("long")).alias("word_chars"),
        F.col("c_symbol").alias("n_symbols"),
        "n_dup_lines",
        F.coalesce(repeated, F.lit(0).cast("long")).alias("n_repeat_words"),
        *(f"c_{c}" for c in [*CLASSES, "other"]),
        found.alias("common"),
    )


def references(measured: DataFrame) -> DataFrame:
    """Per language: words, shares of the character classes, and shares of the common words, over all texts."""
    classes = [f"c_{c}" for c in [*CLASSES, "other"]]
    total = sum((F.sum(c) for c in classes), F.lit(0))
    shares = measured.groupBy("lang").agg(
        F.sum("n_words").alias("ref_words"),
        *((F.sum(c) / F.when(total > 0, total)).alias(f"q_{c}") for c in classes),
    )
    words = measured.select("lang", F.explode("common").alias("x")).groupBy("lang", "x.word").agg(F.sum("x.n").alias("n"))
    words = words.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("ref_common"))
    return shares.join(words, "lang", "left")


def _part(p: Column, q: Column) -> Column:
    """One bin's share of twice the Jensen-Shannon divergence."""

    def side(x: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)

    return side(p) + side(q)


def judge(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    max_class_distance: float = 0.33,
    max_word_distance: float = 0.32,
    min_chars: int = 200,
    min_words: int = 100,
    min_reference_words: int = 1000,
    max_broadcast_languages: int = 1000,
) -> DataFrame:
    """Per row: id, the fixed counts, ``base_failed``, both distances (null if not judged) and ``kept``."""
    measured = store(measures(df, doc_id, text, lang), "quality-measures")
    known = store(references(measured), "quality-references")
    if known.count() <= max_broadcast_languages:  # a row has a few numbers and at most a count for every common word
        known = F.broadcast(known)
    joined = measured.join(known, "lang", "left")

    classes = [f"c_{c}" for c in [*CLASSES, "other"]]
    chars = sum((F.col(c) for c in classes), F.lit(0))
    class_sum = sum((_part(F.col(c) / F.when(chars > 0, chars), F.col(f"q_{c}")) for c in classes), F.lit(0.0))
    judged = F.col("ref_words") >= min_reference_words

    n, ref = F.col("n_words"), F.col("ref_words")
    known_words = F.aggregate("common", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    ref_known = F.aggregate(F.map_values("ref_common"), F.lit(0).cast("long"), lambda a, x: a + x)
    in_text = F.aggregate(
        "common",
        F.lit(0.0),
        lambda a, x: a + _part(x["n"] / n, F.element_at("ref_common", x["word"]) / ref),
    )
    # Words of the reference that the text lacks add their whole share.
    lacking = F.aggregate(
        "common", ref_known.cast("double"), lambda a, x: a - F.element_at("ref_common", x["word"])
    ) / ref
    others = _part((n - known_words) / n, (ref - F.coalesce(ref_known, F.lit(0))) / ref)
    word_sum = F.coalesce(in_text + lacking, F.lit(0.0)) + others

    def distance(doubled: Column) -> Column:
        return F.sqrt(F.greatest(doubled / 2, F.lit(0.0)))

    failed = (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)
    far = (F.coalesce(F.col("class_distance"), F.lit(0.0)) > max_class_distance) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) > max_word_distance
    )
    return joined.select(
        F.col("doc_id").alias(doc_id),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.when(judged & (chars >= min_chars), distance(class_sum)).alias("class_distance"),
        F.when(judged & (n >= min_words), distance(word_sum)).alias("word_distance"),
    ).withColumn("kept", ~F.col("base_failed") & ~far)
