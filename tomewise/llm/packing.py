"""Best-fit packing of tokenized texts into sequences of fixed capacity, in bulk-synchronous sweeps.

Every text becomes its token ids and a closing id; only texts above the capacity are cut. Pieces are sorted by length and
gaps by size. A sweep goes down the lengths and matches each with its successor, the smallest gap that holds it; pieces
and gaps that compete are resolved by rank: the i-th piece of a length gets the i-th gap. The gaps shrink, and the
sweep repeats until the length has no piece or no gap, and what is left opens new sequences.

Pieces of one length are interchangeable, and so are gaps of one size. So a sweep matches whole classes: at most
``capacity`` lengths and as many gap sizes, whatever the number of texts, and its plan is a list of rank intervals. The
pieces themselves stay distributed: tasks rank them within (task, length), counts per task give the global rank, and each
piece looks up its rank in the plan.

Null text is empty: one piece with only the closing id. Repeated rows are packed each. An empty table gives no rows.
"""

from __future__ import annotations

import gc
import json
import os
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tomewise.llm.bpe import byte_letters
from tomewise.llm.common import append_columns, map_rows, store

CAPACITY = 2048
# Parts of words in a task's cache: as many new ones again are kept until the older ones go, unless they were met once more.
KEPT_PARTS = 150_000
# Python takes these for white space, the tokenizer does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"
# The one letter whose lower case is two characters, which may no longer be normalized.
DOTTED = chr(0x130)
# The mark of ids that end a word.
WORD_END = "</w>"
# Fixed value: the tokenizer's own pattern, by which a normalized word falls into parts.
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


# Letters below this are letters to Python and to the pattern alike, and normalizing them is lower-casing.
LATIN = "\u0250"
MARKS = frozenset(",.;:!?")


@lru_cache(1)
def _tokenizer(path: str):
    """The tokenizer, read once in a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(1)
def _bare_tokenizer(path: str):
    """The model of a byte-level tokenizer alone, for parts spelled in its letters with blanks between; and these letters.

    A normalized part passes the other steps unchanged, so they can be left out. None for a tokenizer of another kind.
    """
    from tokenizers import Tokenizer

    tokenizer = _tokenizer(path)
    data = json.loads(tokenizer.to_str())
    steps = data["pre_tokenizer"]
    steps = steps.get("pretokenizers", [steps]) if steps else []
    byte_level = steps[-1] if steps else {}
    if byte_level.get("type") != "ByteLevel" or byte_level["use_regex"] or byte_level["add_prefix_space"]:
        return None
    data |= {"normalizer": None, "post_processor": None}
    data["pre_tokenizer"] = {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}
    return Tokenizer.from_str(json.dumps(data)), {b: x for x, b in byte_letters().items() if b != ord(" ")}


def word_encoder(path: str):
    """A function of a list of texts: their ids as little-endian 32-bit numbers.

    For tokenizers that drop white space, treat words apart and mark their ends: words and parts of words that the task
    met before are looked up. They go with the task, so that a worker's next tasks, of whatever query, have its memory.
    """
    tokenizer, bare = _tokenizer(path), _bare_tokenizer(path)
    special = [x.content for x in tokenizer.get_added_tokens_decoder().values()]
    normalize = tokenizer.normalizer.normalize_str
    vocabulary = tokenizer.get_vocab()
    last = np.zeros(max(vocabulary.values()) + 1, bool)
    last[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
    # The caches hold no cycles, and looking for some in them costs more than the encoding.
    gc.set_threshold(200_000, 20, 100)
    parts: dict[str, bytes] = {}
    aged: dict[str, bytes] = {}

    def whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def parted(word: str) -> list[str]:
        """The parts of a word of Latin letters, normalized before; most are letters, or letters and a mark."""
        if word.isalpha():
            return [word]
        if word[-1] in MARKS and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        return PARTS.findall(word)

    def spell(words: list[str]) -> dict[str, bytes]:
        """The ids of distinct words; their parts that are new are encoded together."""
        latin = [w for w in words if w.isascii() or (max(w) < LATIN and DOTTED not in w)]
        found = list(map(parted, "\n".join(latin).lower().split("\n"))) if latin else []
        encode(recall(set().union(*found)), bare)
        done = {}
        if len(latin) < len(words):
            done = {w: whole(w) for w in words if DOTTED in w}
            others = [w for w in words if DOTTED not in w and not w.isascii() and max(w) >= LATIN]
            more = [PARTS.findall(normalize(w)) for w in others]
            encode(recall(set().union(*more)))
            latin, found = latin + others, found + more
        return done | dict(zip(latin, [parts[x[0]] if len(x) == 1 else b"".join([parts[p] for p in x]) for x in found]))

    def encode(fresh: list[str], bare=None) -> None:
        """The ids of new parts, by the bare tokenizer where it is given; the last id of each part says so."""
        for at in range(0, len(fresh), 4096):
            some = fresh[at : at + 4096]
            text, by = " ".join(some), tokenizer
            if bare:
                by, letters = bare
                text = text.encode().decode("latin-1").translate(letters)
            ids = np.array(by.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(last[ids]) + 1
            if len(ends) != len(some):  # it parts one of them once more
                again = tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
                ids = np.array(again.ids, "<u4")
                ends = np.searchsorted(np.array(again.word_ids, np.int64), np.arange(len(some)), "right")
            data, start = ids.tobytes(), 0
            for part, end in zip(some, (ends * 4).tolist(), strict=True):
                parts[part] = data[start:end]
                start = end

    def recall(words: set[str]) -> list[str]:
        """Take parts from the older half of the cache to the younger; those in neither are returned."""
        fresh = []
        for word in words:
            if word not in parts:
                if (data := aged.get(word)) is None:
                    fresh.append(word)
                else:
                    parts[word] = data
        return fresh

    def work(texts: list) -> list[bytes]:
        nonlocal parts, aged
        if len(parts) > KEPT_PARTS:
            parts, aged = {}, parts
        texts = [t or "" for t in texts]
        odd = [any(x in t for x in SEPARATORS) or any(x in t for x in special) for t in texts]
        # Arrow and Python take the same characters for white space.
        plain = pa.array(["" if alone else t for t, alone in zip(texts, odd, strict=True)], pa.large_string())
        split = pc.utf8_split_whitespace(plain)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # Empty where white space begins or ends a text.
        known = spell([w for w in words if w])
        found = [known[w] if w else b"" for w in words]
        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(sizes) - sizes
        numbers, bounds = coded.indices.to_numpy(), split.offsets.to_numpy().tolist()

        def joined(words: np.ndarray) -> bytes:
            n = sizes[words]
            ends = np.cumsum(n)
            return ids[np.arange(n.sum()) + np.repeat(first[words] - ends + n, n)].tobytes()

        return [
            whole(t) if alone else joined(numbers[start:end])
            for t, alone, start, end in zip(texts, odd, bounds, bounds[1:])
        ]

    return work


def cut(df: DataFrame, tokenizer: str, doc_id: str, text: str, capacity: int, closing: int) -> DataFrame:
    """Pieces of every text, with the task that made them and their rank among its pieces of that length."""
    end = np.array([closing], "<u4").tobytes()

    def start():
        encode = word_encoder(tokenizer)
        task = TaskContext.get().partitionId()
        ranks: dict[int, int] = {}

        def work(names: list, texts: list) -> tuple[list, ...]:
            rows = []
            for name, data in zip(names, encode(texts), strict=True):
                data += end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    n = len(part) // 4
                    rank = ranks[n] = ranks.get(n, -1) + 1
                    rows.append((name, piece, at // 4, n, zlib.crc32(part), task, rank))
            return tuple([r[i] for r in rows] for i in range(7))

        return work

    schema = StructType(
        [
            StructField("doc_id", df.schema[doc_id].dataType),
            StructField("piece", IntegerType(), False),
            StructField("start", LongType(), False),
            StructField("length", LongType(), False),
            StructField("ids_crc32", LongType(), False),
            StructField("task", IntegerType(), False),
            StructField("rank", LongType(), False),
        ]
    )
    return map_rows(df, [doc_id, text], schema, start)


def sweep(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rank intervals (length, first rank, pieces, first sequence, offset): piece i gets sequence first + i."""
    gaps: list[int] = []  # sizes of open gaps, in order
    groups: dict[int, list[tuple[int, int]]] = {}  # size: runs of sequences (first, how many)
    plan, sequences = [], 0

    def open_gap(size: int, first: int, n: int) -> None:
        if size and n:
            if size not in groups:
                insort(gaps, size)
                groups[size] = []
            groups[size].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left and (at := bisect_left(gaps, length)) < len(gaps):
            size = gaps[at]
            first, n = groups[size].pop()
            taken = min(n, left)
            if n > taken:
                groups[size].append((first + taken, n - taken))
            elif not groups[size]:
                del groups[size], gaps[at]
            plan.append((length, rank, taken, first, capacity - size))
            open_gap(size - length, first, taken)
            rank, left = rank + taken, left - taken
        each = capacity // length
        for n, per in ((left // each, each), (1, left % each)):
            for k in range(per if n else 0):
                plan.append((length, rank, n, sequences, k * length))
                rank += n
            if n and per:
                open_gap(capacity - per * length, sequences, n)
                sequences += n
    return plan


def pack(
    df: DataFrame,
    tokenizer: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    closing: int = 0,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = store(cut(df, tokenizer, doc_id, text, capacity, closing), "pieces")

    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.array(sorted(sweep(counts, capacity)), np.int64).reshape(-1, 5)
    shared = df.sparkSession.sparkContext.broadcast(plan)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def start():
        plan = shared.value
        keys = (plan[:, 0] << 44) + plan[:, 1]

        def work(lengths: list, ranks: list, firsts: list) -> tuple[list, list]:
            rank = np.array(ranks, np.int64) + np.array(firsts, np.int64)
            at = np.searchsorted(keys, (np.array(lengths, np.int64) << 44) + rank, "right") - 1
            return (plan[at, 3] + rank - plan[at, 1]).tolist(), plan[at, 4].tolist()

        return work

    fields = [StructField("sequence_id", LongType(), False), StructField("offset", LongType(), False)]
    placed = append_columns(pieces.join(offsets, ["task", "length"]), ["length", "rank", "before"], fields, start)
    return placed.select(
        F.col("doc_id").alias(doc_id), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
