"""Language identification by known words, backing off to shorter and shorter character n-grams.

A word that was learned scores the negative log frequency it has in each language. Any other word takes the
mean score of its longest n-grams of which at least one is known: 5 characters, else 4, and so on to 1. The
score of a text is the mean over its words, and the lowest wins (ties: the language that sorts first).

Null text, or text without a letter, is ``und`` with score 0. Text whose words have no known n-gram, or a model
learned from nothing, falls back to the language of most learned texts (``und`` if there is none).
Repeated rows are scored alike; rows of an empty table give none.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from tomewise.llm.common import append_columns

UNKNOWN = "und"
LONGEST = 5
WORD = re.compile(r"[^\W\d_]+")
# Scores of words that a worker has met and that were not learned are kept up to this number.
KEPT_WORDS = 200_000


@dataclass
class LanguageModel:
    """Languages in order; a row of scores for every learned word and n-gram (n-grams have a blank at word ends)."""

    languages: list[str]
    fallback: str
    words: dict[str, int] = field(default_factory=dict)
    grams: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))


def _scores(entries: list, languages: list[str], totals: dict, penalty: float) -> tuple[dict, np.ndarray]:
    rows: dict[str, int] = {}
    for lang, text, _ in entries:
        rows.setdefault(text, len(rows))
    scores = np.full((len(rows), len(languages)), penalty, np.float32)
    at = {x: i for i, x in enumerate(languages)}
    for lang, text, count in entries:
        scores[rows[text], at[lang]] = -math.log10(count / totals[lang, len(text)])
    return rows, scores


def learn_languages(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    learn: Column | None = None,
    texts_per_language: int = 2000,
    words_per_language: int = 20_000,
    grams_per_language: int = 8_000,
    penalty: float = 7.0,
    order: str = "doc_id",
) -> LanguageModel:
    """Learn from the rows where ``learn`` holds and text and language are present.

    A bounded sample: about ``texts_per_language`` texts of each language (exactly all of them, if there are no more),
    picked by a hash of ``order``. Of each language the most frequent words and n-grams are kept.
    """
    known = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    if learn is not None:
        known = known.filter(learn)
    known = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(order).alias("hash"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return LanguageModel([], UNKNOWN)
    languages = sorted(counts)
    fallback = min(languages, key=lambda x: (-counts[x], x))

    share = F.coalesce(
        *(F.when(F.col("lang") == x, F.lit(texts_per_language / n)) for x, n in sorted(counts.items()))
    )
    sample = known.filter(F.pmod("hash", F.lit(1_000_000)) < share * 1_000_000)
    words = (
        sample.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
        .filter(F.length("word") > 0)
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    grams = F.flatten(
        F.array(
            *(
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.length(padded) - (size - 1), F.lit(1))),
                    lambda i, size=size: F.substring(padded, i, F.lit(size)),
                )
                for size in range(1, LONGEST + 1)
            )
        )
    )
    counted = (
        words.select("lang", "n", F.explode(grams).alias("gram"))
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .filter("n > 1")
        .withColumn("size", F.length("gram"))
    )

    def top(df: DataFrame, name: str, keep: int, *by: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("lang", *by).orderBy(F.desc("n"), name))
        return df.withColumn("rank", rank).filter(F.col("rank") <= keep)

    best_words = [
        (r["lang"], r["word"], r["n"])
        for r in top(words.filter("n > 1"), "word", words_per_language).select("lang", "word", "n").collect()
    ]
    best_grams = [
        (r["lang"], r["gram"], r["n"])
        for r in top(counted, "gram", grams_per_language, "size").select("lang", "gram", "n").collect()
    ]
    total: dict = {}
    for x, _, n in best_words:
        total[x] = total.get(x, 0) + n
    word_rows, word_scores = _scores(
        best_words, languages, {(x, k): n for x, n in total.items() for k in {len(w) for _, w, _ in best_words}}, penalty
    )
    total = {}
    for x, gram, n in best_grams:
        total[x, len(gram)] = total.get((x, len(gram)), 0) + n
    gram_rows, gram_scores = _scores(best_grams, languages, total, penalty)
    return LanguageModel(
        languages,
        fallback,
        word_rows,
        {g: i + len(word_rows) for g, i in gram_rows.items()},
        np.concatenate([word_scores, gram_scores]),
    )


class _Rows(dict):
    """Row of each word in a growing table of scores; -1 for a word without known n-gram."""

    def __init__(self, model: LanguageModel):
        super().__init__(model.words)
        self.model, self.used = model, len(model.scores)
        self.table = np.concatenate([model.scores, np.zeros((1024, model.scores.shape[1]), np.float32)])

    def __missing__(self, word: str) -> int:
        grams, padded, row = self.model.grams, f" {word} ", -1
        for size in range(LONGEST, 0, -1):
            found = [r for i in range(len(padded) - size + 1) if (r := grams.get(padded[i : i + size])) is not None]
            if found:
                if self.used == len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                row = self.used
                self.table[row] = self.table[found].mean(0)
                self.used += 1
                break
        self[word] = row
        return row


def identify(model: LanguageModel):
    """A function of a list of texts: their languages and scores."""
    rows: list[_Rows] = []

    def one(text: str | None) -> tuple[str, float]:
        words = WORD.findall(text.lower()) if text else []
        # Numbers like one half and superscripts stand in words, but are no letters.
        if not any(c.isalpha() for word in words for c in word):
            return UNKNOWN, 0.0
        if not model.languages:
            return UNKNOWN, 0.0
        if not rows or len(rows[0]) > len(model.words) + KEPT_WORDS:
            rows[:] = [_Rows(model)]
        at = np.fromiter(map(rows[0].__getitem__, words), np.int64, len(words))
        at = at[at >= 0]
        if not len(at):
            return model.fallback, 1.0 / len(model.languages)
        mean = rows[0].table[at].mean(0, dtype=np.float64)
        best = int(mean.argmin())
        return model.languages[best], float(1.0 / np.exp((mean[best] - mean) * math.log(10)).sum())

    def work(texts: list) -> tuple[list, list]:
        found = [one(x) for x in texts]
        return [x for x, _ in found], [s for _, s in found]

    return work


def add_language(
    df: DataFrame, model: LanguageModel, text: str = "text", lang_pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``df`` with the predicted language of each whole text and its score (0 to 1, the winner's share)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [StructField(lang_pred, StringType(), False), StructField(score, DoubleType(), False)]
    return append_columns(df, [text], fields, lambda: identify(shared.value))
