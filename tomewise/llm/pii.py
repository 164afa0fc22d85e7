"""Personal data: fixed patterns, and a skip-chain conditional random field that adds what they miss.

The field's nodes are a text's tokens with a digit or an at sign; labels are the kinds and "none". Tokens that stand side
by side share a chain potential, and tokens with the same digits or the same letters share a skip potential, however
far apart: each is tied to the next of its like, so n like tokens make n - 1 edges. Tokens inside a pattern's span are
observed. Loopy message passing yields marginals, and a run of unobserved tokens whose marginals agree on a kind
becomes a span. Potentials are learned by pseudo-likelihood from texts in which the patterns' spans are the labels.

Null text counts as empty and has no spans. Repeated rows are alike. An untrained field (empty table, no tokens) adds
nothing. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, IntegerType, LongType, StringType, StructField, StructType
)

from tomewise.llm.common import append_columns, map_rows, sample_by_hash, store

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = NONE + 1
Span = tuple[int, int, int]  # kind, start, end

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can not begin inside a run of digits, and never gives digits back.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CLUE = re.compile(r"[0-9@]")
REST = re.compile(r"\S*")
EDGE = ".,;:!?()[]{}<>\"'"
NOT_DIGITS = re.compile(r"[^0-9]+")


def _emails(text: str) -> list[Span]:
    spans, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            spans.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    return spans


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[Span]:
    """Spans of the fixed patterns, by kind and start: leftmost, not overlapping within a kind; failures are dropped."""
    if not text or not CLUE.search(text):
        return []
    spans = _emails(text)
    for m in IP.finditer(text):
        if all(int(x[-4:]) <= 255 and not x[:-4].strip("0") for x in m.group().split(".")):
            spans.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := NOT_DIGITS.sub("", m.group())) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(NOT_DIGITS.sub("", m.group())) <= 15:
            spans.append((3, *m.span()))
    return spans


def spell(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


@dataclass
class Token:
    start: int
    end: int
    text: str
    before: str  # the word before
    joined: bool = False  # one white space after the token before


def tokens(text: str) -> list[Token]:
    """Tokens with a digit or an at sign, without punctuation at their ends."""
    found, end, last = [], 0, -2
    while m := CLUE.search(text, end):
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        end = REST.match(text, m.start()).end()
        # The plus sign and brackets at the front belong to numbers.
        raw = text[start:end]
        core = raw.rstrip(EDGE)
        cut = len(core) - len(core.lstrip(EDGE))
        if core[cut:]:
            words = text[max(0, start - 40) : start].split()
            found.append(Token(start + cut, start + len(core), core[cut:], words[-1].lower() if words else "", start == last + 1))
        last = end
    return found


SHAPE = (re.compile(r"[0-9]+"), re.compile(r"[^\W\d_]+"))


def shape(word: str) -> str:
    """Runs of digits as 9 with their length (9 at most), runs of letters as a."""
    return SHAPE[0].sub(lambda m: f"9{min(len(m.group()), 9)}", SHAPE[1].sub("a", word[:64]))[:24]


def _features(found: list[Token], i: int, bits: int) -> list[int]:
    token = found[i]
    digits = sum(c.isdigit() for c in token.text)
    left = found[i - 1] if token.joined else None
    right = found[i + 1] if i + 1 < len(found) and found[i + 1].joined else None
    here = shape(token.text)
    names = [
        "bias", f"s:{here}", f"d:{min(digits, 20)}", f"@{'@' in token.text}", f"+{token.text[:1] == '+'}", f"b:{token.before}",
        f"l:{shape(left.text) if left else ''}", f"r:{shape(right.text) if right else ''}",
        f"t:{shape(left.text) if left else ''}|{here}|{shape(right.text) if right else ''}",
    ]
    return [zlib.crc32(x.encode("utf-8", "replace")) & ((1 << bits) - 1) for x in names]


def _keys(found: list[Token]) -> list[str]:
    """What like tokens have in common: at least four digits in a row of any punctuation, or the lower-cased letters."""
    keys = []
    for t in found:
        digits = NOT_DIGITS.sub("", t.text)
        keys.append(digits if len(digits) >= 4 and not any(c.isalpha() for c in t.text) else t.text.lower() if any(c.isalpha() for c in t.text) else "")
    return keys


def edges(found: list[Token]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges between neighbours, skip edges between a token and the first like it.

    So any two like tokens are two steps apart, however many there are and however far from each other.
    """
    chain = [(i - 1, i) for i, t in enumerate(found) if i and t.joined]
    first: dict[str, int] = {}
    skip = [(at, i) for i, key in enumerate(_keys(found)) if key and (at := first.setdefault(key, i)) != i]
    return chain, skip


def observed(found: list[Token], spans: list[Span]) -> list[int]:
    """The kind of the first base span that each token meets, or NONE."""
    labels, by_start = [], sorted((a, b, k) for k, a, b in spans)
    at = 0
    for t in found:
        while at < len(by_start) and by_start[at][1] <= t.start:
            at += 1
        hit = [k for a, b, k in by_start[at : at + 4] if a < t.end and b > t.start]
        labels.append(hit[0] if hit else NONE)
    return labels


@dataclass
class Field:
    """Log potentials: of features by label, of neighbours' labels, and of like tokens' labels."""

    bits: int = 13
    unary: np.ndarray = field(default_factory=lambda: np.zeros((0, LABELS)))
    chain: np.ndarray = field(default_factory=lambda: np.zeros((LABELS, LABELS)))
    skip: np.ndarray = field(default_factory=lambda: np.zeros((LABELS, LABELS)))


def marginals(model: Field, found: list[Token], labels: list[int], rounds: int = 200, damping: float = 0.3) -> np.ndarray:
    """Label probabilities of each token by loopy sum-product; labels other than NONE are observed.

    Messages pass until they settle, damped so that they do; ``rounds`` ends what does not.
    """
    n = len(found)
    unary = np.stack([model.unary[_features(found, i, model.bits)].sum(0) for i in range(n)])
    seen = np.array(labels) != NONE
    unary[seen] = -30.0
    unary[seen, np.array(labels)[seen]] = 0.0
    chain, skip = edges(found)
    if chain or skip:
        pairs = np.array(chain + skip)
        potential = np.concatenate([np.repeat(model.chain[None], len(chain), 0), np.repeat(model.skip[None], len(skip), 0)])
        source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
        potential = np.concatenate([potential, potential.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        messages = np.zeros((len(source), LABELS))
        for _ in range(rounds):
            belief = unary.copy()
            np.add.at(belief, target, messages)
            out = (belief[source] - messages[back])[:, :, None] + potential
            top = out.max(1)
            new = top + np.log(np.exp(out - top[:, None]).sum(1))
            new -= new.max(1, keepdims=True)
            change = np.abs(new - messages).max()
            messages = damping * messages + (1 - damping) * new
            if change < 1e-4:
                break
        np.add.at(unary, target, messages)
    p = np.exp(unary - unary.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(model: Field, text: str, base: list[Span], floor: float = 0.9) -> list[Span]:
    """Runs of tokens outside base spans that the field assigns to one kind with at least ``floor``."""
    if not len(model.unary):
        return []
    found = tokens(text)
    labels = observed(found, base)
    if all(x != NONE for x in labels):
        return []
    p = marginals(model, found, labels)
    best = p.argmax(1)
    spans: list[list[int]] = []
    grows = False
    for t, free, k, sure in zip(found, labels, best.tolist(), p.max(1).tolist(), strict=True):
        if free != NONE or k == NONE or sure < floor:
            grows = False
        elif grows and t.joined and spans[-1][0] == k:
            spans[-1][2] = t.end
        else:
            spans.append([k, t.start, t.end])
            grows = True
    return [(k, a, b) for k, a, b in spans]


def fit_field(texts: list[tuple[list, list, list, list]], bits: int = 13, steps: int = 250, rate: float = 0.05, decay: float = 1e-4) -> Field:
    """Pseudo-likelihood: each token's label given its features and the labels of the tokens it is tied to.

    A text is (features of tokens, labels, chain edges, skip edges).
    """
    x, y, ties = [], [], []  # a tie: (token, its neighbour's label, table, whether the neighbour comes second)
    for features, labels, chain, skip in texts:
        at = len(y)
        x += features
        y += labels
        for table, pairs in enumerate((chain, skip)):
            for i, j in pairs:
                ties += [(at + i, labels[j], table, 1), (at + j, labels[i], table, 0)]
    if not y:
        return Field()
    x, y = np.array(x), np.array(y)
    tie = np.array(ties, int).reshape(-1, 4)
    truth = np.eye(LABELS)[y]
    w = np.zeros(((1 << bits) + 2 * LABELS * LABELS, LABELS))
    m, v = np.zeros_like(w), np.zeros_like(w)
    # Ties are features too: the row of a tie is its table and the neighbour's label; a symmetric table needs one row.
    row = (1 << bits) + tie[:, 2] * LABELS * LABELS + tie[:, 1]
    for step in range(1, steps + 1):
        z = w[x].sum(1)
        np.add.at(z, tie[:, 0], w[row])
        p = np.exp(z - z.max(1, keepdims=True))
        error = (p / p.sum(1, keepdims=True) - truth) / len(y)
        g = decay * w
        np.add.at(g, x.ravel(), np.repeat(error, x.shape[1], 0))
        np.add.at(g, row, error[tie[:, 0]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    size = 1 << bits
    tables = [w[size + k * LABELS * LABELS :][:LABELS] for k in range(2)]
    chain, skip = ((t + t.T) / 2 for t in tables)
    return Field(bits, w[:size], chain, skip)


def learn_field(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", max_texts: int = 3000, max_tokens: int = 120_000, bits: int = 13
) -> Field:
    """Fit to whole texts: at most ``max_texts`` of those with tokens, picked by a hash of the id and taken in the order of
    a hash of their tokens while they have at most ``max_tokens`` tokens together; a longer one is passed over.
    """

    chosen = sample_by_hash(
        df.filter(F.col(text).rlike("[0-9@]")).select(F.col(doc_id).alias("id")).distinct(), "id", max_texts
    )
    # One text for each id, so that rows that repeat an id do not add to the sample.
    texts = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    texts = texts.groupBy("id").agg(F.min("text").alias("text")).select("text")
    pair = ArrayType(ArrayType(IntegerType()))
    schema = StructType(
        [StructField("x", pair), StructField("y", ArrayType(IntegerType())), StructField("c", pair), StructField("s", pair)]
    )

    def read():
        def work(values: list) -> tuple[list, ...]:
            rows = []
            for value in values:
                found = tokens(value or "")
                if 0 < len(found) <= max_tokens:
                    labels = observed(found, base_spans(value))
                    rows.append(([_features(found, i, bits) for i in range(len(found))], labels, *([list(e) for e in es] for es in edges(found))))
            return tuple([r[i] for r in rows] for i in range(4))

        return work

    # At most max_texts rows of a few numbers are ordered; only what fits is collected.
    rows = store(map_rows(texts, ["text"], schema, read).withColumn("order", F.xxhash64("y", "x")), "field-sample")
    so_far = Window.orderBy("order")
    sizes = rows.select("order", F.size("y").alias("n")).withColumn("total", F.sum("n").over(so_far))
    fits = F.broadcast(sizes.filter(F.col("total") <= max_tokens).select("order").distinct())
    taken = rows.join(fits, "order", "left_semi").select("x", "y", "c", "s")
    return fit_field([tuple(r) for r in taken.collect()], bits)


def add_spans(
    df: DataFrame, model: Field, text: str = "text", base: str = "base", spans: str = "spans"
) -> DataFrame:
    """``df`` with the base spans and with all spans, each as an array of (kind, start, end) by kind and start."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = ArrayType(
        StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
    )

    def read():
        def work(texts: list) -> tuple[list, list]:
            found = [base_spans(t) for t in texts]
            more = [sorted(b + added_spans(shared.value, t, b)) if t and CLUE.search(t) else b for t, b in zip(texts, found, strict=True)]
            return [[(KINDS[k], i, j) for k, i, j in sorted(x)] for x in found], [[(KINDS[k], i, j) for k, i, j in x] for x in more]

        return work

    return append_columns(df, [text], [StructField(base, kind, False), StructField(spans, kind, False)], read)


def digest(df: DataFrame, model: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, base spans of each kind, a digest of the base spans, and all spans as text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def read():
        def work(texts: list) -> tuple[list, ...]:
            found = [base_spans(t) for t in texts]
            counts = [[sum(k == x for k, _, _ in spans) for spans in found] for x in range(len(KINDS))]
            hashes = [hashlib.sha256(spell(spans).encode()).hexdigest() for spans in found]
            more = [spell(b + added_spans(shared.value, t, b)) if t and CLUE.search(t) else "" for t, b in zip(texts, found, strict=True)]
            return (*counts, hashes, more)

        return work

    fields = [StructField(f"n_{k}", LongType(), False) for k in KINDS]
    fields += [StructField("base_sha256", StringType(), False), StructField("spans", StringType(), False)]
    return append_columns(df.select(doc_id, text), [text], fields, read).drop(text)


def redact(df: DataFrame, text: str = "text", doc_id: str = "doc_id", model: Field | None = None) -> DataFrame:
    """``df`` with every span of ``text`` replaced by its kind in brackets; of overlapping spans the first counts."""
    model = model or learn_field(df, text, doc_id)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def one(value: str | None) -> str | None:
        if not value or not CLUE.search(value):
            return value
        base = base_spans(value)
        parts, end = [], 0
        for start, stop, kind in sorted((a, b, k) for k, a, b in base + added_spans(shared.value, value, base)):
            if start >= end:
                parts += [value[end:start], f"[{KINDS[kind].upper()}]"]
            end = max(end, stop)
        return "".join(parts) + value[end:]

    columns = df.columns
    kind = StructField(text, StringType(), True)
    return append_columns(df, [text], [kind], lambda: lambda texts: ([one(t) for t in texts],)).select(columns)
