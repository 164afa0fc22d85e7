"""A toxicity classifier that is indifferent to which group a text mentions.

Features of a text are the words it holds and the beginnings (4 to 6 letters) of longer words. A logistic model is
fitted to labelled texts; each labelled text that mentions an identity term has a counterfactual, in which every such
term is swapped for another of its language, and the squared difference of the two scores (log odds) is penalised.
So a group's name can not carry weight that another name does not, however often it stands near insults.

Null and empty texts have no features: their score is the model's base rate. Repeated rows are scored alike; a text
labelled more than once counts as toxic if any label says so. A model learned from nothing, or from one class only,
scores every text with the share of toxic ones (0 without labels).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField

from tomewise.llm.common import append_columns, sample_by_hash

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
KEPT_WORDS = 200_000

# Terms that name groups of people; within a tuple any may stand for any other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "jews", "christians", "hindus", "buddhists", "atheists"),
    ("muslim", "jewish", "christian", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("blind", "deaf", "disabled", "autistic"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "juden", "christen", "hindus"),
    ("ausländer", "flüchtlinge", "einwanderer", "deutsche"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "juifs", "chrétiens", "hindous"),
    ("immigrés", "réfugiés", "étrangers", "français"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "judíos", "cristianos", "hindúes"),
    ("inmigrantes", "refugiados", "extranjeros", "españoles"),
)
SWAP = {term: group[(i + 1) % len(group)] for group in IDENTITY_TERMS for i, term in enumerate(group)}


@dataclass
class ToxicityModel:
    features: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -30.0


def word_features(word: str) -> list[str]:
    """The word, and its beginnings marked by a star."""
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) > k)]


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def counterfactual(words: set[str]) -> set[str]:
    """The words with each identity term swapped for the next of its group."""
    return {SWAP.get(w, w) for w in words}


def _ids(words: set[str], features: dict[str, int]) -> list[int]:
    return sorted({i for w in words for f in word_features(w) if (i := features.get(f)) is not None})


def fit(
    texts: list[tuple[int, list[int], list[int]]],
    size: int,
    counterfactual_weight: float = 5.0,
    decay: float = 1e-4,
    steps: int = 400,
    rate: float = 0.1,
) -> tuple[np.ndarray, float]:
    """Weights and bias from (label, feature ids, feature ids of the counterfactual or the same)."""
    y = np.array([t[0] for t in texts], float)
    lengths = np.array([len(t[1]) for t in texts])
    row, col = np.repeat(np.arange(len(texts)), lengths), np.array([i for t in texts for i in t[1]], int)
    swapped = [(k, set(t[1]) - set(t[2]), set(t[2]) - set(t[1])) for k, t in enumerate(texts) if t[1] != t[2]]
    pairs = [(k, i, s) for k, (_, gone, come) in enumerate(swapped) for part, s in ((gone, 1.0), (come, -1.0)) for i in part]
    p_row, p_col = np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)
    p_sign = np.array([p[2] for p in pairs])
    # The rarer class weighs as much as a quarter of all texts, if it has less.
    weight = np.where(y == 1, max(1.0, 0.25 * len(y) / max(y.sum(), 1)), 1.0)
    weight /= weight.sum()

    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = np.bincount(row, w[col], len(texts)) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.append(np.bincount(col, error[row], size) + decay * w, error.sum())
        if len(pairs):
            gap = np.bincount(p_row, p_sign * w[p_col], len(swapped))
            g[:-1] += 2 * counterfactual_weight / len(swapped) * np.bincount(p_col, p_sign * gap[p_row], size)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    toxic: str = "toxic",
    learn: Column | None = None,
    max_texts: int = 16_000,
    max_features: int = 4_000,
    min_texts: int = 4,
    **fitting,
) -> ToxicityModel:
    """Fit to labelled texts where ``learn`` holds: a bounded sample of at most ``max_texts`` by a hash of the id.

    The features are the ``max_features`` that tell the classes apart best (chi-squared, in at least
    ``min_texts`` texts), and every identity term.
    """
    marked = labels.filter(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
    if learn is not None:
        marked = marked.filter(learn)
    marked = marked.groupBy(F.col(doc_id).alias("id")).agg(F.max(F.col(toxic).cast("int")).alias("y"))
    chosen = sample_by_hash(marked, "id", max_texts)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")

    def read():
        return lambda values: ([sorted({f for w in words_of(t) for f in word_features(w)}) for t in values],)

    held = append_columns(
        texts.select("y", "text"), ["text"], [StructField("found", ArrayType(StringType()), False)], read
    ).select("y", "found")
    total = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("p")).head()
    n, p = total["n"], total["p"]
    if p in (0, n):
        return ToxicityModel(bias=30.0 if n else -30.0) if p else ToxicityModel()
    counts = (
        held.select("y", F.explode("found").alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("n"), F.sum("y").alias("p"))
        .filter(F.col("n") >= min_texts)
    )
    expected = F.col("n") * (p / n)
    spread = (F.col("p") - expected) * (F.col("p") - expected)
    best = counts.orderBy(F.desc(spread / (expected * (1 - p / n))), "feature").limit(max_features)
    names = [r["feature"] for r in best.select("feature").collect()]
    features = {f: i for i, f in enumerate(dict.fromkeys([*names, *SWAP]))}
    shared = docs.sparkSession.sparkContext.broadcast(features)

    def rows():
        def work(values: list) -> tuple[list, list]:
            sets = [words_of(t) for t in values]
            return [_ids(s, shared.value) for s in sets], [_ids(counterfactual(s), shared.value) for s in sets]

        return work

    kind = ArrayType(IntegerType())
    matrix = append_columns(
        texts.select("y", "text"), ["text"], [StructField("ids", kind), StructField("swapped", kind)], rows
    )
    data = [(r["y"], r["ids"], r["swapped"]) for r in matrix.select("y", "ids", "swapped").collect()]
    weights, bias = fit(data, len(features), **fitting)
    return ToxicityModel(features, weights, bias)


def scorer(model: ToxicityModel):
    """A function of a list of texts: their scores."""
    kept: dict[str, tuple] = {}

    def one(text: str | None) -> float:
        if len(kept) > KEPT_WORDS:
            kept.clear()
        found: set[int] = set()
        for word in words_of(text):
            ids = kept.get(word)
            if ids is None:
                ids = kept[word] = tuple(_ids({word}, model.features))
            if ids:
                found.update(ids)
        z = model.bias + sum(float(model.weights[i]) for i in sorted(found))
        return float(1 / (1 + np.exp(-min(max(z, -60.0), 60.0))))

    return lambda texts: ([one(t) for t in texts],)


def add_toxicity(df: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with the score of each whole text: 0 to 1, higher is likelier toxic."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return append_columns(df, [text], [StructField(score, DoubleType(), False)], lambda: scorer(shared.value))
