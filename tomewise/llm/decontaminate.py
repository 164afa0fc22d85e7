"""Benchmark decontamination: where documents repeat a benchmark's phrases, found through full-text indexes of shards.

Words are runs of digits, letters a to z (A to Z lower-cased) and characters beyond ASCII. A phrase is ``words``
consecutive words of a benchmark item, or a whole item of fewer. Every task cuts its documents into shards, builds an
FM-index over each shard's words, searches all phrases backwards through ranks of a wavelet matrix, locates the
occurrences by sampled suffix places, and merges them into spans. Documents are neither shuffled nor collected.

Words that no phrase holds end every match, so of a shard's words only the runs without such a word are indexed, and
runs that several documents repeat are indexed once. Both are exact.

The phrases of up to ``BLOCK_BYTES`` of items are broadcast. A larger benchmark is searched in blocks of that size,
block by block; what the blocks find is then joined to the documents by a digest of their texts.

Texts that are null, empty or without words have no hit. Items without words have no phrase; an item without id marks
words like others and counts as an item with an empty id; rows that repeat an item_id are one item. Repeated rows of
documents each get their row; all columns stay, those named like new ones are replaced; empty tables give no rows,
or rows without hits. A document is never split, so one must fit into a task's memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tomewise.llm.common import BROADCAST_BYTES, store

# Bytes of items whose phrases are searched at once, and of texts that share an index.
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 16 << 20

# Every so many-th suffix place is kept; the others are found by steps back to one that is.
SAMPLE_RATE = 16

FOUND = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start: bigint, end: bigint>>"

# Per byte: letters in lower case, other bytes of words as they are, and a space for the rest.
_FOLDED = "".join(chr(b).lower() if chr(b).isalnum() and b < 128 else " " for b in range(128))
FOLD = _FOLDED.encode() + bytes(range(128, 256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text; bytes beyond ASCII belong to words, so UTF-8 can be cut as it stands."""
    return text.encode().translate(FOLD).split() if text else []


class Bits:
    """Bits in words of 64, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros((bits.size // 64 + 1) * 8, np.uint8)
        padded[: packed.size] = packed
        self.words = padded.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.total = int(self.before[-1])

    def ones(self, places: np.ndarray) -> np.ndarray:
        """How many ones there are before each place."""
        at = places >> 6
        low = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & low)

    def get(self, places: np.ndarray) -> np.ndarray:
        return (self.words[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    """Symbols bit by bit, each level stably parted by the bit before: ranks of any symbol in a step per bit."""

    def __init__(self, symbols: np.ndarray, width: int):
        self.levels = []
        for shift in reversed(range(width)):
            ones = (symbols >> shift) & 1 == 1
            bits = Bits(ones)
            self.levels.append((shift, symbols.size - bits.total, bits))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        first, last = np.zeros_like(places), places
        for shift, zeros, bits in self.levels:
            one = (symbols >> shift) & 1 == 1
            a, b = bits.ones(first), bits.ones(last)
            first, last = np.where(one, zeros + a, first - a), np.where(one, zeros + b, last - b)
        return last - first

    def symbol_and_rank(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before."""
        symbols, first = np.zeros_like(places), np.zeros_like(places)
        for _, zeros, bits in self.levels:
            one = bits.get(places)
            a, b = bits.ones(first), bits.ones(places)
            first, places = np.where(one, zeros + a, first - a), np.where(one, zeros + b, places - b)
            symbols = symbols * 2 + one
        return symbols, places - first


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix starts in order; zeros, of which one is last, count as different symbols in the order of their places.

    Prefix doubling: suffixes that agree in their first symbols are told apart by the ranks of what follows. No two
    agree beyond a zero, so a tie never reaches the end. Only ties are sorted again.
    """
    n = symbols.size
    ends = symbols == 0
    rank = symbols.astype(np.int64) + int(ends.sum())
    rank[ends] = np.arange(int(ends.sum()))
    order = np.argsort(rank, kind="stable")
    places, suffixes, keys, step = np.arange(n), order, rank[order], 1
    while True:
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        rank[suffixes] = np.maximum.accumulate(np.where(new, places, 0))
        tied = ~(new & np.concatenate([new[1:], [True]]))
        places, suffixes = places[tied], suffixes[tied]
        if not places.size:
            return order
        keys = rank[suffixes] * n + rank[suffixes + step]
        again = np.argsort(keys, kind="stable")
        keys, suffixes = keys[again], suffixes[again]
        order[places] = suffixes
        step *= 2


class FMIndex:
    """Full-text index of runs of symbols from 1 on, each followed by a zero."""

    def __init__(self, symbols: np.ndarray, largest: int, rate: int = SAMPLE_RATE):
        order = suffix_order(symbols)
        before = symbols[order - 1].astype(np.int64)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=largest + 1))])
        self.last_column = WaveletMatrix(before, largest.bit_length())
        # Steps back stop where a run starts, since zeros are not told apart in the last column.
        kept = (order % rate == 0) | (before == 0)
        self.kept, self.places = Bits(kept), order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) row of each phrase; phrases are rows, shorter ones with zeros before them."""
        symbol = phrases[:, -1]
        first, last = self.smaller[symbol], self.smaller[symbol + 1]
        for column in reversed(range(phrases.shape[1] - 1)):
            going = np.flatnonzero((first < last) & (phrases[:, column] > 0))
            symbol = phrases[going, column]
            first[going], last[going] = (
                self.smaller[symbol] + self.last_column.rank(symbol, rows[going]) for rows in (first, last)
            )
        return first, last

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places of rows: steps back until one is kept."""
        found, left, steps = np.empty_like(rows), np.arange(rows.size), 0
        while left.size:
            kept = self.kept.get(rows)
            found[left[kept]] = self.places[self.kept.ones(rows[kept])] + steps
            left, rows = left[~kept], rows[~kept]
            symbols, ranks = self.last_column.symbol_and_rank(rows)
            rows = self.smaller[symbols] + ranks
            steps += 1
        return found


class Phrases:
    """The phrases of some items: words by number, a row of word numbers for each phrase, and its items."""

    def __init__(self, items: list[tuple[str, str | None]], words: int):
        self.numbers: dict[bytes, int] = {}
        self.items = sorted({item for item, _ in items})
        number = {item: i for i, item in enumerate(self.items)}
        parts, owners = [np.zeros((0, words), np.int64)], []
        for item, text in items:
            symbols = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            if symbols:
                padded = np.array([0] * (words - len(symbols)) + symbols)
                parts.append(np.lib.stride_tricks.sliding_window_view(padded, words))
                owners += [number[item]] * len(parts[-1])
        self.rows, which = np.unique(np.concatenate(parts), axis=0, return_inverse=True)
        which = which.reshape(-1)
        self.lengths = (self.rows > 0).sum(1)
        self.owners = np.array(owners, np.int64)[np.argsort(which, kind="stable")]
        self.first_owner = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(self.rows)))])

    def owners_of(self, phrases: np.ndarray) -> set[str]:
        return {self.items[i] for p in phrases for i in self.owners[self.first_owner[p] : self.first_owner[p + 1]]}


def _runs(known: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of at least ``least`` true values; the last value is false."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], known]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    enough = ends - starts >= least
    return starts[enough], ends[enough]


def search_shard(texts: list[str | None], phrases: Phrases) -> Iterator[tuple[int, list[tuple[int, int]], set[str]]]:
    """For each text its number of words, the merged spans of words that phrases cover, and the items they are of."""
    get = phrases.numbers.get
    # A zero, like that of an unknown word, ends each text.
    parts = [np.array([get(w, 0) for w in words_of(t)] + [0], np.int64) for t in texts]
    first = np.concatenate([[0], np.cumsum([p.size for p in parts])])
    symbols = np.concatenate(parts)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    least = int(phrases.lengths.min()) if phrases.lengths.size else 1
    starts, ends = _runs(symbols > 0, least)
    if phrases.lengths.size and starts.size:
        different: dict[bytes, int] = {}
        run_of = [different.setdefault(symbols[a:b].tobytes(), len(different)) for a, b in zip(starts, ends)]
        runs = [np.frombuffer(run, np.int64) for run in different]
        offsets = np.concatenate([[0], np.cumsum([run.size + 1 for run in runs])])
        indexed = np.zeros(offsets[-1], np.int64)
        for at, run in zip(offsets, runs):
            indexed[at : at + run.size] = run
        index = FMIndex(indexed, len(phrases.numbers))
        low, high = index.search(phrases.rows)
        phrase = np.repeat(np.arange(low.size), high - low)
        rows = np.arange(phrase.size) + np.repeat(low - np.concatenate([[0], np.cumsum(high - low)[:-1]]), high - low)
        places = index.locate(rows)
        change = np.bincount(places, minlength=indexed.size + 1) - np.bincount(
            places + phrases.lengths[phrase], minlength=indexed.size + 1
        )
        covered = np.cumsum(change) > 0
        run_at = np.searchsorted(offsets, places, "right") - 1
        hits = np.unique(np.stack([run_at, phrase], 1), axis=0)
        of_run = {r: (offsets[r], phrases.owners_of(hits[hits[:, 0] == r, 1])) for r in np.unique(hits[:, 0])}
        for start, run in zip(starts, run_of):
            if run in of_run:
                at, owners = of_run[run]
                doc = int(np.searchsorted(first, start, "right")) - 1
                shift = int(start - first[doc])
                cover = np.concatenate([covered[at : at + runs[run].size], [False]])
                spans[doc] += [(int(a) + shift, int(b) + shift) for a, b in zip(*_runs(cover, 1))]
                items[doc] |= owners
    for part, span, owners in zip(parts, spans, items):
        yield part.size - 1, span, owners


def in_code_points(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of the text's code points, end exclusive."""
    if not spans:
        return []
    raw = text.encode()
    # A code point starts at each byte that does not continue one.
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    bounds = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(FOLD))]
    return [(int(points[bounds[a][0]]), int(points[bounds[b - 1][1]])) for a, b in spans]


def _search(docs: DataFrame, block: Phrases, text: str, shard_bytes: int) -> DataFrame:
    """``docs`` with the columns FOUND, for the phrases of one block."""
    found = StructType.fromDDL(FOUND)
    old = [c for c in docs.columns if c not in found.names]
    schema = StructType([*(docs.schema[c] for c in old), *found])
    kinds = to_arrow_schema(found)
    read = docs.select(*(F.col(f"`{c}`") for c in old if c != text), F.col(f"`{text}`").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def shard(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for batch in batches for t in batch.column("_text").to_pylist()]
        results = search_shard(texts, shared.value)
        for batch in batches:
            mine = list(zip(batch.column("_text").to_pylist(), (next(results) for _ in range(batch.num_rows))))
            columns = {
                "n_words": [n for _, (n, _, _) in mine],
                "n_hit": [sum(b - a for a, b in spans) for _, (_, spans, _) in mine],
                "items": [sorted(items) for _, (_, _, items) in mine],
                "spans": [
                    [{"start": a, "end": b} for a, b in in_code_points(t or "", spans)] for t, (_, spans, _) in mine
                ],
            }
            arrays = [batch.column("_text" if c == text else c) for c in old]
            arrays += [pa.array(columns[kind.name], kind.type) for kind in kinds]
            yield pa.RecordBatch.from_arrays(arrays, names=[*old, *kinds.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= shard_bytes:
                yield from shard(held)
                held = []
        if held:
            yield from shard(held)

    return read.mapInArrow(run, schema)


def _blocks(benchmark: DataFrame, item: str, text: str, words: int, block_bytes: int) -> Iterator[Phrases]:
    """The benchmark in blocks of about ``block_bytes`` (of one item, if that is longer); one at a time is collected."""
    bounded = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text")
    ).filter("text is not null")
    size = bounded.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).head()[0] or 0
    blocks = -(-size // block_bytes) or 1
    # Rows of one item may be in several blocks; the items found are united in the end.
    number = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for i in range(blocks):
        yield Phrases([(r.item, r.text) for r in bounded.filter(number == i).distinct().collect()], words)


def _merged(spans: Column) -> Column:
    """Spans that overlap become one; they come sorted by start."""
    empty = F.array().cast("array<struct<start: bigint, end: bigint>>")

    def add(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        apart = last.isNull() | (span["start"] > last["end"])
        return F.when(apart, F.concat(done, F.array(span))).otherwise(
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        )

    return F.aggregate(spans, empty, add)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    words: int = 10,
    text: str = "text",
    item: str = "item_id",
    block_bytes: int = BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside an occurrence of a phrase), ``items`` (ids of the items whose
    phrases occur, sorted as text) and ``spans`` (of code points from the first to the last word of each merged span).
    """
    blocks = _blocks(benchmark, item, "text", words, block_bytes)
    found = _search(docs, next(blocks), text, shard_bytes)
    rest = list(_later(docs, blocks, text, shard_bytes))
    if not rest:
        return found
    # Spans of several blocks can overlap, so words are counted again, in the texts of the merged spans.
    digest = F.sha2(F.col(f"`{text}`"), 256)
    first = found.filter("n_hit > 0").select(digest.alias("_digest"), "items", "spans").dropDuplicates(["_digest"])
    hits = first
    for more in rest:
        hits = hits.unionByName(more)
    hits = store(
        hits.groupBy("_digest").agg(
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_items"),
            _merged(F.sort_array(F.flatten(F.collect_list("spans")))).alias("_spans"),
        ),
        "leaks",
    )
    size = hits.agg(F.sum(F.size("_items") * 64 + F.size("_spans") * 64 + 128)).head()[0] or 0
    hits = F.broadcast(hits) if size <= BROADCAST_BYTES else hits
    cut = F.transform("_spans", lambda s: F.substr(F.col(f"`{text}`"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    counted = F.aggregate(
        cut, F.lit(0).cast("bigint"), lambda n, part: n + F.size(F.regexp_extract_all(part, F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"), F.lit(0)))
    )
    joined = found.withColumn("_digest", digest).join(hits, "_digest", "left")
    kept = [F.col(f"`{c}`") for c in found.columns if c not in ("n_hit", "items", "spans")]
    return joined.select(
        *kept,
        F.coalesce(counted, F.col("n_hit")).alias("n_hit"),
        F.coalesce("_items", "items").alias("items"),
        F.coalesce("_spans", "spans").alias("spans"),
    )


def _later(docs: DataFrame, blocks: Iterator[Phrases], text: str, shard_bytes: int) -> Iterator[DataFrame]:
    """What each further block finds, by digest of text: stored, so that no two blocks are held at once."""
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    for block in blocks:
        found = _search(texts, block, "text", shard_bytes).filter("n_hit > 0")
        yield store(found.select(F.sha2("text", 256).alias("_digest"), "items", "spans").dropDuplicates(["_digest"]), "block")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, words: int = 10, text: str = "text") -> DataFrame:
    """``docs`` without the spans that repeat phrases of the benchmark; what stood around a span is joined as it is."""
    found = find_leaks(docs.withColumn("_kept", F.col(f"`{text}`")), benchmark, words, "_kept")
    # From the end of each span to the start of the next.
    gaps = F.transform(
        F.sequence(F.lit(0), F.size("spans")),
        lambda i: F.substr(
            F.col("_kept"),
            (F.coalesce(F.get("spans", i - 1)["end"], F.lit(0)) + 1).cast("int"),
            (F.coalesce(F.get("spans", i)["start"], F.length("_kept")) - F.coalesce(F.get("spans", i - 1)["end"], F.lit(0))).cast("int"),
        ),
    )
    cleaned = F.when(F.size("spans") > 0, F.array_join(gaps, "")).otherwise(F.col("_kept"))
    lost = [c for c in StructType.fromDDL(FOUND).names if c in docs.columns]
    if lost:
        raise ValueError(f"columns {lost} would be lost")
    return found.withColumn(text, cleaned).select(*(F.col(f"`{c}`") for c in docs.columns))


def digest(docs: DataFrame, benchmark: DataFrame, words: int = 10) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` for each document."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark, words)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# Occurrences by a join of all windows of documents with all phrases; written from the definitions.
_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"
ORACLE_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark
), phrases AS (
  SELECT item, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase, least(len(w), 10) AS n
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT n FROM phrases
), windows AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS phrase
  FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
), hits AS (
  SELECT DISTINCT r, i, n, item FROM windows JOIN phrases USING (phrase, n)
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(n)) AS t(k) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""
