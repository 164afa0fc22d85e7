"""A small corpus with copies, near copies, a hot word and empty books."""

from __future__ import annotations

import math
import random
from collections import Counter
from itertools import combinations


def make(n: int, seed: int, copies: bool = True) -> list[tuple[str, str]]:
    draw = random.Random(seed)
    vocabulary = ["w" + "".join(draw.choices("abcdefgh", k=3)) for _ in range(40)]
    texts = []
    for _ in range(n):
        size = draw.choice([0, 1, 3, 8, 20])
        words = draw.choices(vocabulary, k=size)
        texts.append(" ".join(words + ["hotword"] * (size > 1)))
    if copies:
        # A third of the books are copies of one, in other word orders.
        model = " ".join(draw.choices(vocabulary, k=12))
        for _ in range(n // 2):
            words = model.split()
            draw.shuffle(words)
            texts.append(" ".join(words))
        texts += [model + " extra" + "abcdefgh"[i] for i in range(4)]
    draw.shuffle(texts)
    return [(f"b{i:03}", text) for i, text in enumerate(texts)]


def weights(books: list[tuple[str, str]]) -> dict[str, dict[str, float]]:
    counts = {key: Counter(text.split()) for key, text in books}
    frequency = Counter(word for words in counts.values() for word in words)
    return {
        key: {
            word: count / sum(words.values()) * math.log(len(books) / frequency[word])
            for word, count in words.items()
        }
        for key, words in counts.items()
        if words
    }


def cosines(vectors: dict[str, dict[str, float]]) -> dict[tuple[str, str], float]:
    norms = {key: math.sqrt(sum(w * w for w in v.values())) for key, v in vectors.items()}
    result = {}
    for a, b in combinations(sorted(vectors), 2):
        dot = sum(w * vectors[b].get(word, 0.0) for word, w in vectors[a].items())
        length = norms[a] * norms[b]
        result[a, b] = dot / length if length else 0.0
    return result
