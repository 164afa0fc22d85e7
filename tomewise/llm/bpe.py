"""Byte-level BPE with a lexicon of frequent words in a minimal acyclic transducer, and exact merges for the rest.

The most frequent words of the corpus are encoded once, and compiled into a minimal acyclic automaton: words share
prefixes and suffixes, and the arcs carry how many words they pass over, so that the sum along a word's path is its number
and leads to its ids. Tasks read the automaton from a memory map. A word that it does not hold is merged exactly: of
all adjacent pairs the one that was learned first, and of those the leftmost, is joined, until none is known.

Null text is empty: no ids, and it decodes to the empty text. Repeated rows are encoded alike; an empty table gives no
rows. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import tempfile
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tomewise.llm.common import SLICE_ROWS, append_columns, map_rows, most_frequent

# White space as the tokenizer's patterns see it.
SPACE = "\t-\r \x85\xa0  -     　"
# A word with the blank before it, or a run of white space without the blank that goes to the next word.
CHUNK = re.compile(f"( ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+)")
PARTS = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
# Words that a worker keeps, about 250 bytes each.
KEPT_WORDS = 500_000
# Letters below this are letters to Python and to the pattern alike, and fall into one part.
LATIN = "\u0250"
# Marks that make one part behind letters; an apostrophe may belong to what follows it, but then the word does not end in marks.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LONG_WORD = 256
# Ranks lie below.
NO_PAIR = np.int64(1) << 30


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself if it can be printed, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Vocabulary:
    """Bytes of every id, the id of every byte, and the merges as a sorted table of pairs."""

    pieces: list[bytes]
    byte_ids: np.ndarray
    pairs: np.ndarray  # left id * 2^32 + right id
    ranks: np.ndarray
    joined: np.ndarray
    special: dict[str, int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters, ids = byte_letters(), data["model"]["vocab"]
        special = {x["content"]: x["id"] for x in data["added_tokens"]}
        pieces = [b""] * (max([*ids.values(), *special.values()]) + 1)
        for token, i in ids.items():
            pieces[i] = bytes(letters[c] for c in token)
        for token, i in special.items():
            pieces[i] = token.encode()
        byte_ids = np.array([ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])])
        merges = [(ids[a] << 32 | ids[b], rank, ids[a + b]) for rank, (a, b) in enumerate(data["model"]["merges"])]
        pairs, ranks, joined = np.array(sorted(merges), np.int64).T
        return cls(pieces, byte_ids, pairs, ranks, joined, special)


def _merge_long(ids: list[int], table: dict[int, tuple[int, int]]) -> list[int]:
    """Exact merges of one long word with a heap of its pairs."""
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(table[k][0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (k := ids[i] << 32 | ids[i + 1]) in table]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue
        ids[i], ids[j] = table[a << 32 | b][1], -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for left in (before[i], i):
            if left >= 0 and (right := after[left]) < n and (k := ids[left] << 32 | ids[right]) in table:
                heapq.heappush(heap, (table[k][0], left, ids[left], ids[right]))
    return [x for x in ids if x >= 0]


class Merger:
    """Exact merges of many words at once: in each round every word joins its first-learned leftmost pair."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.table: dict[int, tuple[int, int]] | None = None

    def __call__(self, words: list[bytes]) -> list[list[int]]:
        done: list = [None] * len(words)
        for i, word in enumerate(words):
            if len(word) > LONG_WORD:
                if self.table is None:
                    v = self.v
                    self.table = dict(zip(v.pairs.tolist(), zip(v.ranks.tolist(), v.joined.tolist())))
                done[i] = _merge_long(self.v.byte_ids[np.frombuffer(word, np.uint8)].tolist(), self.table)
        short = [i for i, x in enumerate(done) if x is None and words[i]]
        sizes = np.array([len(words[i]) for i in short], np.int64)
        ids = self.v.byte_ids[np.frombuffer(b"".join(words[i] for i in short), np.uint8)].astype(np.int64)
        owner = np.repeat(np.arange(len(short)), sizes)
        # The rank of the pair at each place, and what it joins to; only pairs beside a merge are looked up again.
        rank = np.full(len(ids), NO_PAIR)
        joined = np.zeros(len(ids), np.int64)

        def look_up(places: np.ndarray) -> None:
            places = places[(places >= 0) & (places < len(ids) - 1)]
            key = ids[places] << 32 | ids[places + 1]
            at = np.minimum(np.searchsorted(self.v.pairs, key), len(self.v.pairs) - 1)
            known = (self.v.pairs[at] == key) & (owner[places] == owner[places + 1])
            rank[places] = np.where(known, self.v.ranks[at], NO_PAIR)
            joined[places] = self.v.joined[at]

        look_up(np.arange(len(ids)))
        while len(ids):
            rank[-1] = NO_PAIR
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.minimum.reduceat(rank << 32 | np.arange(len(ids)), starts)
            open_words = least < NO_PAIR << 32
            if not open_words.all():
                ends = np.append(starts[1:], len(ids))
                for k in np.flatnonzero(~open_words).tolist():
                    done[short[owner[starts[k]]]] = ids[starts[k] : ends[k]].tolist()
            first = least[open_words] & 0xFFFFFFFF
            ids[first] = joined[first]
            keep = np.repeat(open_words, np.diff(np.append(starts, len(ids))))
            keep[first + 1] = False
            merged = (np.cumsum(keep) - 1)[first]
            ids, owner, rank, joined = ids[keep], owner[keep], rank[keep], joined[keep]
            look_up(np.concatenate([merged - 1, merged]))
        return [x if x is not None else [] for x in done]


class Lexicon:
    """A minimal acyclic automaton over words' bytes; a word's number leads to its ids."""

    ARRAYS = ("arcs", "targets", "skips", "final", "offsets", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays

    @classmethod
    def compile(cls, words: dict[bytes, list[int]]) -> Lexicon:
        """From distinct words with their ids; states with equal continuations are one."""
        order = sorted(words)
        register: dict[tuple, int] = {}
        states: list[tuple[bool, list[tuple[int, int]]]] = []
        path: list[list] = [[False, []]]  # open states: final, arcs
        letters: list[int] = []

        def close(depth: int) -> None:
            while len(path) - 1 > depth:
                final, arcs = path.pop()
                state = register.setdefault((final, tuple(arcs)), len(states))
                if state == len(states):
                    states.append((final, arcs))
                path[-1][1].append((letters.pop(), state))

        last = b""
        for word in order:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            close(same)
            for letter in word[same:]:
                letters.append(letter)
                path.append([False, []])
            path[-1][0] = True
            last = word
        close(0)
        states.append((path[0][0], path[0][1]))  # the root is the last state
        counts: list[int] = []
        arcs, targets, skips = [], [], []
        for state, (final, out) in enumerate(states):
            passed = int(final)
            for letter, to in out:
                arcs.append(state << 8 | letter)
                targets.append(to)
                skips.append(passed)
                passed += counts[to]
            counts.append(passed)
        ids = [words[w] for w in order]
        return cls(
            {
                "arcs": np.array(arcs, np.int64),
                "targets": np.array(targets, np.int64),
                "skips": np.array(skips, np.int64),
                "final": np.array([f for f, _ in states], np.int64),
                "offsets": np.cumsum([0, *map(len, ids)]).astype(np.int64),
                "ids": np.array(list(chain.from_iterable(ids)), np.int64),
            }
        )

    def pack(self) -> tuple[list[int], bytes]:
        """Sizes of the arrays and their bytes, one after the other."""
        return [len(self.arrays[k]) for k in self.ARRAYS], b"".join(self.arrays[k].tobytes() for k in self.ARRAYS)

    @classmethod
    def map(cls, sizes: list[int], data: bytes) -> Lexicon:
        """Read from a memory map of a file without a name, which goes with the process."""
        with tempfile.TemporaryFile() as file:
            file.write(data or b"\0")
            file.flush()
            mapped = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        flat = np.frombuffer(mapped, np.int64, sum(sizes))
        ends = np.cumsum(sizes)
        return cls({k: flat[e - n : e] for k, n, e in zip(cls.ARRAYS, sizes, ends.tolist(), strict=True)})

    def find(self, words: list[bytes]) -> list[list[int] | None]:
        """The ids of each word, or None; all words walk the automaton together."""
        a = self.arrays
        number = np.full(len(words), -1, np.int64)
        if not len(words) or not len(a["arcs"]):
            return [None] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        first = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        alive = np.arange(len(words))
        state = np.full(len(words), len(a["final"]) - 1, np.int64)
        passed = np.zeros(len(words), np.int64)
        depth = 0
        while len(alive):
            ended = sizes[alive] == depth
            stop = ended & (a["final"][state] == 1)
            number[alive[stop]] = passed[stop]
            alive, state, passed = alive[~ended], state[~ended], passed[~ended]
            key = state << 8 | data[first[alive] + depth]
            at = np.minimum(np.searchsorted(a["arcs"], key), len(a["arcs"]) - 1)
            there = a["arcs"][at] == key
            alive, state, passed = alive[there], a["targets"][at[there]], passed[there] + a["skips"][at[there]]
            depth += 1
        offsets, ids = a["offsets"], a["ids"]
        return [ids[offsets[n] : offsets[n + 1]].tolist() if n >= 0 else None for n in number.tolist()]


def _parted(word: str) -> list[str]:
    """The parts of a word by the tokenizer's pattern; most are letters, or letters and marks."""
    stem = word.rstrip(MARKS)
    if (stem[1:] if stem[:1] == " " else stem).isalpha() and (stem.isascii() or max(stem) < LATIN):
        return [stem, word[len(stem) :]] if len(stem) < len(word) else [word]
    return PARTS.findall(word)


def _merge_parts(merger: Merger, words: list[str], lexicon: Lexicon | None = None) -> list[list[int]]:
    """Exact ids of words: each is parted by the tokenizer's pattern, and equal parts are looked up or merged once."""
    parted = list(map(_parted, words))
    parts = list(set().union(*parted))
    spelled = [p.encode("utf-8", "surrogatepass") for p in parts]
    found = lexicon.find(spelled) if lexicon else [None] * len(parts)
    merged = iter(merger([p for p, known in zip(spelled, found) if known is None]))
    ids = {p: next(merged) if known is None else known for p, known in zip(parts, found)}
    return [ids[x[0]] if len(x) == 1 else list(chain.from_iterable([ids[p] for p in x])) for x in parted]


def chunk_encoder(vocabulary: Vocabulary, lexicon: Lexicon, entry: Callable[[list[int]], Any], kept: dict[str, Any]):
    """A function of a list of texts: the entries of each text's words, made once from a word's ids and kept."""
    merger = Merger(vocabulary)
    specials = {t: entry([i]) for t, i in vocabulary.special.items()}
    special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None

    def work(texts: list) -> list[list]:
        if len(kept) > KEPT_WORDS:
            kept.clear()
        kept.update(specials)
        split = []
        for t in texts:
            if not t:
                split.append([])
            elif special and any(x in t for x in specials):
                parts = special.split(t)
                split.append(
                    list(chain.from_iterable([x] if i % 2 else CHUNK.findall(x) for i, x in enumerate(parts)))
                )
            else:
                split.append(CHUNK.findall(t))
        new = [w for w in set().union(*split) if w not in kept]
        found = lexicon.find([w.encode("utf-8", "surrogatepass") for w in new])
        rest = [w for w, ids in zip(new, found) if ids is None]
        kept.update((w, entry(ids)) for w, ids in zip(new, found) if ids is not None)
        kept.update(zip(rest, map(entry, _merge_parts(merger, rest, lexicon))))
        return [list(map(kept.__getitem__, x)) for x in split]

    return work


def encoder(vocabulary: Vocabulary, lexicon: Lexicon):
    """A function of a list of texts: the ids of each."""
    chunks = chunk_encoder(vocabulary, lexicon, list, {})
    return lambda texts: [list(chain.from_iterable(x)) for x in chunks(texts)]


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The text of ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join(map(vocabulary.pieces.__getitem__, ids)).decode("utf-8", "replace")


def frequent_words(df: DataFrame, text: str = "text", max_words: int = 60_000, flush: int = 300_000) -> list[str]:
    """The most frequent words, at most ``max_words``, with the blank before them, counted over all texts.

    Each task counts on its own and passes its counts on whenever it holds ``flush`` words.
    """
    schema = StructType([StructField("word", StringType(), False), StructField("n", LongType(), False)])
    arrow = pa.schema([("word", pa.large_string()), ("n", pa.int64())])
    sent = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches):
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            one = pa.concat_tables(held or [arrow.empty_table()])
            return one.group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"])

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                texts = batch.column(0).slice(at, SLICE_ROWS).cast(pa.large_string())
                found = pc.utf8_split_whitespace(texts).flatten().value_counts()
                held.append(pa.Table.from_arrays([found.field(0), found.field(1)], schema=arrow))
                if sum(t.num_rows for t in held) >= 2 * flush:
                    held = [summed().rename_columns(arrow.names)]
                    if held[0].num_rows >= flush:
                        yield from held.pop().cast(sent).to_batches()
        yield from summed().rename_columns(arrow.names).cast(sent).to_batches()

    counted = df.select(F.col(text).alias("text")).mapInArrow(count, schema).groupBy("word").agg(F.sum("n").alias("n"))
    counted = counted.filter("word != ''")  # where white space begins or ends a text
    return [" " + r["word"] for r in most_frequent(counted.filter("n > 1"), max_words).select("word").collect()]


def compile_lexicon(vocabulary: Vocabulary, words: list[str]) -> Lexicon:
    """The transducer of words; those with white space inside or a special token are left to the encoder."""
    words = [w for w in words if CHUNK.findall(w) == [w] and not any(x in w for x in vocabulary.special)]
    ids = _merge_parts(Merger(vocabulary), words)
    return Lexicon.compile({w.encode("utf-8"): x for w, x in zip(words, ids, strict=True)})


@lru_cache(1)
def _worker_state(path: str) -> tuple[Vocabulary, dict]:
    """The vocabulary, and what a worker keeps from task to task: words with their number of ids, these as text, and the
    bytes that they decode to."""
    return Vocabulary.read(path), {}


def digest(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", max_words: int = 60_000) -> DataFrame:
    """Per row: id, number of ids, and digests of the ids and of the text that they decode to."""
    vocabulary = Vocabulary.read(path)
    lexicon = compile_lexicon(vocabulary, frequent_words(df, text, max_words))
    shared = df.sparkSession.sparkContext.broadcast(lexicon.pack())

    def start():
        vocabulary, kept = _worker_state(path)
        names = [str(i) for i in range(len(vocabulary.pieces))]

        def entry(ids: list[int]) -> tuple[int, str, bytes]:
            return len(ids), ",".join([names[i] for i in ids]), b"".join([vocabulary.pieces[i] for i in ids])

        chunks = chunk_encoder(vocabulary, Lexicon.map(*shared.value), entry, kept)

        def work(texts: list) -> tuple[list, list, list]:
            counts, ids_hash, text_hash = [], [], []
            for entries in chunks(texts):
                sizes, ids, pieces = zip(*entries) if entries else ((), (), ())
                counts.append(sum(sizes))
                ids_hash.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
                decoded = b"".join(pieces).decode("utf-8", "replace")
                text_hash.append(hashlib.sha256(decoded.encode()).hexdigest())
            return counts, ids_hash, text_hash

        return work

    fields = [
        StructField("n_tokens", LongType(), False),
        StructField("ids_sha256", StringType(), False),
        StructField("decoded_sha256", StringType(), False),
    ]
    return append_columns(df.select(doc_id, text), [text], fields, start).drop(text)
