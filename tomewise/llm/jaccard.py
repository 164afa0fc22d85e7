"""Near-duplicate groups by the Jaccard similarity of word shingles, found with token-combination prefixes.

A text's tokens are its distinct shingles of ``words`` words. If two sets are similar, at most ``e`` tokens of either are
missing in the other (e = n - ceil(t n)). With all tokens in one global order, a prefix that covers e + 1 mismatches
therefore shares a signature with the other's prefix. The order has four classes:

1. Tokens of the counted universe (a quarter of all hashes) that only one set has. They cover a mismatch each and need no
   index, since nothing can match them. Most sets have e + 1 of these: they are done, without any candidate.
2. Other tokens outside that universe, if they are rare: each is indexed by itself and covers one.
3. The same, if they are frequent: combinations of k are indexed, and c tokens cover c - k + 1.
4. The rest, each by itself.

Prefixes are extended until the sum reaches e + 1. In sets of up to ``small_set`` tokens k is 2; in larger ones, where
combinations would outnumber the tokens, it is 1. Small sets whose partner may be larger are indexed both ways.
Which tokens count as frequent only steers the work: any choice finds the same links. The most frequent ones are
counted over the prefixes of all sets that are left, and up to ``max_frequent`` are broadcast.

Pairs are not spelled out within groups. Equal sets are one. Of the sets that share a signature, each is first verified
against one hub, and the links make components. Then only members of different components that still share a signature
are compared. Where more than ``crowd`` sets share a signature, the sets that such signatures tie together are a crowd:
its members are cut into blocks by size, every two blocks of fitting sizes meet in one task, which counts common tokens
in numpy and returns only as many links as join its members. All other signatures yield pairs, fewer than ``crowd`` for
each set. So no link is lost that would join two components.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType
)

from tomewise.llm.common import append_columns, map_rows, most_frequent, small, store
from tomewise.llm.components import components

# Odd multipliers, one for each place in a shingle.
STEP = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def shingles(text: str | None, words: int) -> np.ndarray:
    """Distinct shingle hashes in order: a-z for A-Z, words parted by ASCII white space.

    A text of fewer words is one shingle; without words there is none.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.zeros(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(words, len(found))
    rows = len(found) - size + 1
    mixed = np.full(rows, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashes[k : k + rows]) * np.uint64(STEP * (2 * k + 1) & MASK | 1)
        mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique((mixed ^ (mixed >> np.uint64(29))).view(np.int64))


def spare(n: int, percent: int) -> int:
    """How many of n tokens a similar set can lack."""
    return n - (percent * n + 99) // 100


def fingerprint(tokens: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None


def counted(tokens: np.ndarray) -> np.ndarray:
    """Which tokens are in the universe whose frequencies are counted: a quarter of all hashes."""
    return (tokens >= 0) & (tokens < 1 << 62)


def signatures(tokens: np.ndarray, need: int, frequent: np.ndarray, percent: int, small: int) -> np.ndarray:
    """What a set is indexed by, to cover ``need`` more mismatches; ``frequent`` is sorted."""
    n = len(tokens)
    inside = counted(tokens)
    mine, last = tokens[~inside], tokens[inside]
    often = np.zeros(len(mine), bool)
    if len(frequent):
        often = frequent[np.minimum(np.searchsorted(frequent, mine), len(frequent) - 1)] == mine
    rare, rest = mine[~often][:need], mine[often]
    left = need - len(rare)
    if left <= 0:
        return rare
    parts = [rare]
    if n > small or 100 * n > percent * small:
        parts.append(rest[:left])
        if len(rest) < left:
            parts.append(last)
    if n <= small:
        if len(rest) <= left:  # c tokens cover c - 1 as pairs, which is too few here
            parts += [rest, last]
        pairs = list(combinations(rest[: left + 1].view(np.uint64).tolist(), 2))
        if pairs:
            a, b = np.array(pairs, np.uint64).T
            both = (a * np.uint64(STEP) ^ b) * np.uint64(0x94D049BB133111EB)
            parts.append((both ^ (both >> np.uint64(32))).view(np.int64))
    return np.unique(np.concatenate(parts))


def near_duplicates(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 4,
    percent: int = 85,
    small_set: int = 64,
    frequent: int = 32,
    max_frequent: int = 200_000,
    probe: int = 8,
    crowd: int = 48,
) -> DataFrame:
    """One row per row of ``df``: id, n_shingles, component_id (the least id that links reach).

    Two texts link if 100 * intersection >= percent * union. Null or wordless texts have no shingles and are
    alone. Repeated ids are separate rows, and rows with a null id take part without giving a component its id.
    """
    spark = df.sparkSession
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast(StringType()).alias("text"))

    def read():
        def work(texts: list) -> tuple[list, ...]:
            sets = [shingles(t, words) for t in texts]
            return [len(s) for s in sets], [fingerprint(s) for s in sets], [s[counted(s)] for s in sets]

        return work

    fields = [
        StructField("n", IntegerType(), False),
        StructField("set", BinaryType()),
        StructField("tokens", ArrayType(LongType()), False),
    ]
    rows = append_columns(docs, ["text"], fields, read).drop("text")
    rows = store(rows.withColumn("v", F.monotonically_increasing_id()), "counted-tokens")

    # Rows with equal sets are one: the first stands for all.
    first = rows.filter("n > 0").groupBy("set").agg(F.min("v").alias("first"))
    same = store(rows.filter("n > 0").select("v", "set").join(first, "set").select("v", "first"), "equal-sets")
    nodes = rows.filter("n > 0").join(small(store(same.filter("v != first").select("v"), "copies")), "v", "left_anti")

    # How many mismatches are left to cover, after the tokens that no other set has.
    owners = nodes.select("v", F.explode("tokens").alias("token")).groupBy("token")
    owners = owners.agg(F.min("v").alias("v"), F.count("*").alias("sets")).filter("sets = 1")
    lone = owners.groupBy("v").agg(F.count("*").cast("int").alias("lone"))
    lacking = F.col("n") - ((F.col("n").cast("long") * percent + 99) / 100).cast("int")
    need = lacking + 1 - F.coalesce("lone", F.lit(0))
    left = nodes.select("v", "n", "set").join(lone, "v", "left").withColumn("need", need).filter("need > 0")
    left = store(left.select("v", "set", "need"), "sets-left")
    sets = _sets(docs, left, words, percent, probe)

    def heads():
        def work(found: list, needs: list) -> tuple[list]:
            sets = (np.array(x, np.int64) for x in found)
            return (np.concatenate([s[~counted(s)][:k] for s, k in zip(sets, needs, strict=True)]),)

        return work

    token = StructType([StructField("token", LongType(), False)])
    seen = map_rows(sets, ["tokens", "need"], token, heads).groupBy("token").agg(F.count("*").alias("n"))
    top = most_frequent(seen.filter(F.col("n") > frequent), max_frequent)
    often = np.sort(top.select("token").toArrow().column(0).to_numpy().astype(np.int64))
    shared = spark.sparkContext.broadcast(often)

    def index():
        def work(found: list, needs: list) -> tuple[list]:
            sets = (np.array(x, np.int64) for x in found)
            return ([signatures(s, k, shared.value, percent, small_set) for s, k in zip(sets, needs, strict=True)],)

        return work

    kind = [StructField("sigs", ArrayType(LongType()), False)]
    indexed = append_columns(sets.select("v", "tokens", "need"), ["tokens", "need"], kind, index)
    postings = store(indexed.select("v", F.explode("sigs").alias("sig")), "postings")

    # Signatures of one set only can not link anything.
    hubs = postings.groupBy("sig").agg(F.min("v").alias("hub"), F.count("*").alias("sets")).filter("sets > 1")
    met = store(postings.join(small(store(hubs.select("sig", "hub"), "hubs")), "sig"), "shared-signatures")

    stars = met.filter("v != hub").select(F.col("hub").alias("a"), F.col("v").alias("b")).distinct()
    links = _similar(stars, sets, percent)
    roots = components(links)
    mixed, crowded = _mixed(met, roots, crowd)
    more = _similar(_across(mixed), sets, percent)
    more = store(more.union(_in_crowds(crowded, sets, percent)), "links")
    if not more.isEmpty():
        roots = components(links.union(more))

    # Components of rows: sets that no link reaches stand for themselves.
    root = F.coalesce("root", "first")
    of_row = same.join(roots.withColumnRenamed("v", "first"), "first", "left").select("v", root.alias("root"))
    grouped = rows.select("v", "doc_id", "n").join(of_row, "v", "left")
    least = grouped.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows"))
    # Only components of several rows are looked up, so that no row is shuffled by its root while they are few.
    least = small(store(least.filter("rows > 1").select("root", "component_id", F.lit(True).alias("found")), "components"))
    return grouped.join(least, "root", "left").select(
        F.col("doc_id").alias(doc_id),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("found") & (F.col("n") > 0), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def head(tokens: np.ndarray, percent: int, probe: int) -> np.ndarray:
    """The first tokens by hash, cut to 32 bits: ``probe`` more than a similar set can lack, and one.

    Of the two sets' heads, the one that ends first is within the other's range, so all but e of its tokens are in the
    other head. Cutting tokens only adds matches, but for those that it makes equal within a head.
    """
    return np.unique(tokens[: spare(len(tokens), percent) + 1 + probe].view(np.uint64) >> np.uint64(32)).astype(
        np.uint32
    ).view(np.int32)


def _sizes(a: str, b: str, percent: int):
    """Sets of too different sizes can not be similar."""
    return 100 * F.least(a, b).cast("long") >= percent * F.greatest(a, b).cast("long")


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar: those whose sizes and heads allow it are verified in full."""
    pairs = store(pairs, "pairs")
    n = F.size("tokens")
    lacking = n - ((n.cast("long") * percent + 99) / 100).cast("int")
    known = sets.select("v", n.alias("n"), "head", (F.size("head") - lacking).alias("least"))
    a = known.select(F.col("v").alias("a"), F.col("n").alias("n_a"), F.col("head").alias("x"), F.col("least").alias("least_a"))
    b = known.select(F.col("v").alias("b"), F.col("n").alias("n_b"), F.col("head").alias("y"), F.col("least").alias("least_b"))
    likely = (
        pairs.join(a, "a")
        .join(b, "b")
        .filter(_sizes("n_a", "n_b", percent))
        .filter(F.size(F.array_intersect("x", "y")) >= F.least("least_a", "least_b"))
    )
    likely = store(likely.select("a", "b"), "likely-pairs")
    left = sets.select(F.col("v").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("v").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    verified = (
        likely.join(left, "a")
        .join(right, "b")
        .select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("all"))
        .filter(100 * F.col("both") >= percent * (F.col("all") - F.col("both")))
    )
    return store(verified.select("a", "b"), "links")


def _sets(docs: DataFrame, wanted: DataFrame, words: int, percent: int, probe: int) -> DataFrame:
    """(v, need, tokens, head) of the sets in ``wanted`` (v, set, need), stored."""

    def read():
        def work(texts: list) -> tuple[list, list]:
            sets = [s for t in texts if len(s := shingles(t, words))]
            return [fingerprint(s) for s in sets], sets, [head(s, percent, probe) for s in sets]

        return work

    schema = StructType(
        [
            StructField("set", BinaryType(), False),
            StructField("tokens", ArrayType(LongType()), False),
            StructField("head", ArrayType(IntegerType()), False),
        ]
    )
    found = map_rows(docs.select("text"), ["text"], schema, read).join(small(wanted), "set")
    found = found.groupBy("v").agg(*(F.first(c).alias(c) for c in ("need", "tokens", "head")))
    return store(found, "token-sets")


def _mixed(met: DataFrame, roots: DataFrame, crowd: int) -> tuple[DataFrame, DataFrame]:
    """(sig, v, root) of signatures that sets of different components share: those of few sets, those of many."""
    at = met.select("sig", "v").join(roots, "v", "left").select("sig", "v", F.coalesce("root", "v").alias("root"))
    mixed = at.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("sets"))
    mixed = small(store(mixed.filter("low != high").select("sig", "sets"), "mixed-signatures"))
    at = store(at.join(mixed, "sig"), "mixed-postings")
    return at.filter(F.col("sets") <= crowd).drop("sets"), at.filter(F.col("sets") > crowd).drop("sets")


def _across(at: DataFrame) -> DataFrame:
    """Pairs of sets that share a signature and are in different components."""
    a = at.select("sig", F.col("root").alias("root_a"), F.col("v").alias("a"))
    b = at.select("sig", F.col("root").alias("root_b"), F.col("v").alias("b"))
    # A signature has few sets here, so each set meets few others.
    return a.join(b, "sig").filter("a < b and root_a != root_b").select("a", "b").distinct()


def _in_crowds(at: DataFrame, sets: DataFrame, percent: int, block: int = 512) -> DataFrame:
    """Links (a, b) that join all members of a crowd that links join, a crowd being tied by signatures."""
    first = at.groupBy("sig").agg(F.min("v").alias("hub"))
    ties = at.join(first, "sig").select(F.col("hub").alias("a"), F.col("v").alias("b")).distinct()
    crowds = components(ties).withColumnRenamed("root", "crowd")
    members = crowds.join(sets.select("v", F.size("tokens").alias("n")), "v")

    # Blocks by size: runs of sizes that hold about ``block`` members, cut again by hash if one size holds more.
    sizes = members.groupBy("crowd", "n").agg(F.count("*").alias("m"))
    before = Window.partitionBy("crowd").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    runs = sizes.withColumn("run", F.floor(F.coalesce(F.sum("m").over(before), F.lit(0)) / block))
    held = runs.groupBy("crowd", "run").agg(F.sum("m").alias("m"), F.min("n").alias("low"), F.max("n").alias("high"))
    held = held.withColumn("parts", F.ceil(F.col("m") / block).cast("int"))
    held = store(held, "crowd-runs")
    a = held.select("crowd", *(F.col(c).alias(f"{c}_a") for c in ("run", "parts", "low", "high")))
    b = held.select("crowd", *(F.col(c).alias(f"{c}_b") for c in ("run", "parts", "low", "high")))
    fits = a.join(b, "crowd").filter("run_a <= run_b").filter(100 * F.col("high_a").cast("long") >= percent * F.col("low_b").cast("long"))
    cells = fits.select(
        "crowd", "run_a", "run_b",
        F.explode(F.sequence(F.lit(0), F.col("parts_a") - 1)).alias("part_a"), "parts_b",
    ).select("crowd", "run_a", "run_b", "part_a", F.explode(F.sequence(F.lit(0), F.col("parts_b") - 1)).alias("part_b"))
    cells = cells.filter("run_a < run_b or part_a <= part_b").withColumn("cell", F.monotonically_increasing_id())
    cells = small(store(cells, "crowd-cells"))

    placed = members.join(small(store(runs.select("crowd", "n", "run"), "runs")), ["crowd", "n"])
    placed = placed.join(held.select("crowd", "run", "parts"), ["crowd", "run"])
    placed = placed.withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
    placed = store(placed.select("crowd", "run", "part", "v").join(sets.select("v", "tokens"), "v"), "crowd-members")

    def side(name: str) -> DataFrame:
        mine = cells.select("cell", "crowd", F.col(f"run_{name}").alias("run"), F.col(f"part_{name}").alias("part"))
        found = placed.join(mine, ["crowd", "run", "part"])
        return found.select(*(F.col(c).alias(f"{c}_{name}") for c in ("cell", "v", "tokens")))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        links = _spanning_links(_flat(left, "a"), _flat(right, "b"), percent)
        return pa.table({"a": pa.array(links[0], pa.int64()), "b": pa.array(links[1], pa.int64())})

    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])
    return side("a").groupBy("cell_a").cogroup(side("b").groupBy("cell_b")).applyInArrow(compare, schema)


def _flat(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, sizes and all tokens of the sets, one after the other."""
    lists = table.column(f"tokens_{name}").combine_chunks()
    return (
        table.column(f"v_{name}").to_numpy().astype(np.int64),
        pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64),
        lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
    )


def _spanning_links(left: tuple, right: tuple, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Similar pairs of the two blocks, as few as join what all similar pairs join."""
    (a_ids, a_sizes, a_tokens), (b_ids, b_sizes, b_tokens) = left, right
    if not len(a_ids) or not len(b_ids):
        return a_ids[:0], a_ids[:0]
    both = _common(a_sizes, a_tokens, b_sizes, b_tokens)
    similar = 100 * both >= percent * (a_sizes[:, None] + b_sizes[None] - both)
    i, j = np.nonzero(similar & (a_ids[:, None] != b_ids[None]))
    root = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(a_ids[i].tolist(), b_ids[j].tolist(), strict=True)):
        if (p := top(x)) != (q := top(y)):
            root[p] = q
            kept.append(k)
    return a_ids[i[kept]], b_ids[j[kept]]


def _common(a_sizes: np.ndarray, a_tokens: np.ndarray, b_sizes: np.ndarray, b_tokens: np.ndarray) -> np.ndarray:
    """How many tokens each set of one block has in common with each of the other.

    Tokens that many sets have are columns of a matrix product; others are counted pair by pair.
    """
    shared = np.intersect1d(a_tokens, b_tokens)
    both = np.zeros((len(a_sizes), len(b_sizes)), np.int64)
    if not len(shared):
        return both

    def held(sizes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(sizes)), sizes)
        at = np.minimum(np.searchsorted(shared, tokens), len(shared) - 1)
        found = shared[at] == tokens
        order = np.argsort(at[found], kind="stable")
        return at[found][order], rows[found][order]

    (a_at, a_row), (b_at, b_row) = held(a_sizes, a_tokens), held(b_sizes, b_tokens)
    a_n, b_n = np.bincount(a_at, minlength=len(shared)), np.bincount(b_at, minlength=len(shared))
    often = a_n * b_n > both.size // 64
    columns = np.flatnonzero(often)
    place = np.cumsum(often) - 1
    for start in range(0, len(columns), 2048):
        part = (place >= start) & (place < start + 2048) & often
        x = np.zeros((len(a_sizes), 2048), np.float32)
        y = np.zeros((len(b_sizes), 2048), np.float32)
        use = part[a_at]
        x[a_row[use], place[a_at[use]] - start] = 1
        use = part[b_at]
        y[b_row[use], place[b_at[use]] - start] = 1
        both += (x @ y.T).astype(np.int64)
    # The rest: for each set of one block that has a token, all sets of the other that have it.
    use = ~often[a_at]
    times = b_n[a_at[use]]
    b_start = np.cumsum(b_n) - b_n
    inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    rows = np.repeat(a_row[use], times)
    others = b_row[np.repeat(b_start[a_at[use]], times) + inner]
    both += np.bincount(rows * len(b_sizes) + others, minlength=both.size).reshape(both.shape)
    return both
