"""Approximate nearest neighbours by cosine with balanced posting lists.

Equal vectors are one, with their least ids. Centroids are fitted to a bounded sample, and over-full clusters give
their surplus to a second centroid, so that lists have like sizes. Every vector goes to its nearest list, and a
vector near a boundary also to others whose distance is within a ratio of the nearest, unless one of them stands
for the same direction. A query walks a graph of the centroids, held in memory, from some spread over it to ever nearer
ones, and reads every list whose distance is within a ratio of the nearest one's, however many these are. The ratio is
found out on the table itself: a bounded sample of the queries is compared with all vectors, and the ratio is the least
that finds the asked share of those neighbours; an infinite one reads all lists and is exact. Lists are joined with
the queries that read them in blocks of bounded size, so neither a hot list nor a hot region meets in one task. Scores
are exact.

Vectors that are null, zero or hold null or non-finite components take no part; neither do rows without an id, and
vectors of another length than most. Repeated rows count once. Ties go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tomewise.llm.common import append_columns, sample_by_hash, small, store


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = 12, fullest: float = 2.0) -> np.ndarray:
    """Spherical k-means of unit vectors; in each round, over-full clusters get the centroids of the emptiest ones."""
    rng = np.random.default_rng(0)
    points = sample[np.sort(rng.permutation(len(sample))[:lists])].copy()
    for step in range(rounds):
        near = (sample @ points.T).argmax(1)
        sizes = np.bincount(near, minlength=len(points))
        sums = np.zeros_like(points)
        np.add.at(sums, near, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        points = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), points)
        if step < rounds - 2:
            order = np.argsort(sizes, kind="stable")
            full = [k for k in order[::-1] if sizes[k] > fullest * len(sample) / len(points)]
            for empty, k in zip(order.tolist(), full):
                if sizes[empty] * 2 < sizes[k]:
                    members = np.flatnonzero(near == k)
                    points[empty] = sample[members[rng.integers(len(members))]]
    return points


def assign(centroids: np.ndarray, vectors: np.ndarray, replicas: int, ratio: float) -> list[list[int]]:
    """The lists of each unit vector, nearest first: those within the ratio and not behind a list it is already in."""
    distance = np.sqrt(np.maximum(2 - 2 * vectors @ centroids.T, 0))
    order = np.argsort(distance, 1, kind="stable")[:, : 4 * replicas]
    lists = []
    for row, near in enumerate(order.tolist()):
        first = distance[row, near[0]]
        kept = [near[0]]
        for c in near[1:]:
            if len(kept) == replicas or distance[row, c] > ratio * first:
                break
            apart = np.sqrt(np.maximum(2 - 2 * centroids[kept] @ centroids[c], 0))
            if (apart >= 0.6 * distance[row, c]).all():
                kept.append(c)
        lists.append(kept)
    return lists


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Of each unit vector to each centroid."""
    return np.sqrt(np.maximum(1 + (centroids * centroids).sum(1) - 2 * vectors @ centroids.T, 0))


def graph(centroids: np.ndarray, near: int = 16, far: int = 4) -> np.ndarray:
    """Each centroid's links: to its nearest others, and to some drawn at random, which tie regions together."""
    n = len(centroids)
    links = [np.argsort(-(centroids[at : at + 512] @ centroids.T), 1, kind="stable")[:, : near + 1] for at in range(0, n, 512)]
    return np.concatenate([np.concatenate(links), np.random.default_rng(1).integers(n, size=(n, far))], 1)


def walk(
    centroids: np.ndarray, links: np.ndarray, queries: np.ndarray, ratio: float, least: float, beam: int = 8, step: int = 4
) -> np.ndarray:
    """Distances of each unit query to the centroids that its walk meets, infinite to others.

    From about sqrt(n) entries, links of the nearest centroids are followed while these are within ``ratio`` of the
    nearest (``least`` at least), or among the ``beam`` nearest met so far.
    """
    n, step = len(centroids), min(step, len(centroids))
    met, followed = np.full((len(queries), n), np.inf), np.zeros((len(queries), n), bool)
    entries = np.unique(np.linspace(0, n - 1, int(np.ceil(np.sqrt(n)))).astype(int))
    met[:, entries] = distances(queries, centroids[entries])
    norms = (centroids * centroids).sum(1)
    active = np.arange(len(queries))
    while len(active):
        now = met[active]
        bound = np.maximum(ratio * np.maximum(now.min(1), least), np.partition(now, min(beam, n) - 1, 1)[:, min(beam, n) - 1])
        now[followed[active]] = np.inf
        next_ = np.argpartition(now, step - 1, 1)[:, :step]
        value = np.take_along_axis(now, next_, 1)
        use = np.isfinite(value) & (value <= bound[:, None])
        row, at = np.repeat(active, step).reshape(-1, step)[use], next_[use]
        followed[row, at] = True
        row, to = np.repeat(row, links.shape[1]), links[at].ravel()
        new = np.isinf(met[row, to])
        row, to = row[new], to[new]
        met[row, to] = np.sqrt(np.maximum(1 + norms[to] - 2 * np.einsum("ij,ij->i", queries[row], centroids[to]), 0))
        active = active[use.any(1)]
    return met


def lists_to_read(
    centroids: np.ndarray, links: np.ndarray, queries: np.ndarray, ratio: float, least: float, full: np.ndarray
) -> list[list[int]]:
    """The lists within the ratio of each unit query, nearest first; further ones up to the first that is ``full``.

    So a query finds as many vectors as a full list holds, or reads all lists if none is full.
    """
    met = walk(centroids, links, queries, ratio, least)
    lost = ~(np.isfinite(met) & full).any(1)
    met[lost] = distances(queries[lost], centroids)
    order = np.argsort(met, 1, kind="stable")
    near = np.take_along_axis(met, order, 1)
    within = (near <= ratio * np.maximum(near[:, :1], least)) & np.isfinite(near)
    first = np.where(full.any(), full[order].argmax(1), len(full) - 1) + 1
    counts = np.maximum(within.sum(1), first)
    return [row[:n] for row, n in zip(order.tolist(), counts.tolist(), strict=True)]


def tuned(needed: np.ndarray, recall: float) -> float:
    """The ratio that finds a share ``recall`` of neighbours which need such ratios."""
    return float(np.sort(needed)[max(0, int(np.ceil(recall * len(needed))) - 1)]) if len(needed) else 1.0


def _usable(vector: Column) -> Column:
    """Whether a vector has only finite components, and one that is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    df: DataFrame,
    queries: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    list_size: int = 512,
    max_sample: int = 32_768,
    sample_list: int = 8,
    replicas: int = 2,
    replica_ratio: float = 1.02,
    ratio: float | None = None,
    recall: float = 0.99,
    max_trial: int = 512,
    block: int = 2048,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for every row where ``queries`` holds.

    The centroids are fitted to at
    most ``max_sample`` distinct vectors, picked by a hash; all vectors are indexed. Each list has ``sample_list`` vectors
    of the sample or more, so that in a large table lists are longer, and none is left out. Without a ``ratio``, at most
    ``max_trial`` queries, picked by a hash, are compared with all vectors, and the ratio is the least that finds a share
    ``recall`` of their neighbours; an infinite ratio reads all lists.
    """
    spark = df.sparkSession
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("q"))
    # A negative zero equals zero in a score, but not as a key.
    rows = rows.filter(F.col("id").isNotNull() & _usable(F.col("v"))).withColumn("v", F.transform("v", lambda x: x + 0.0))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").head()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    dims = sizes["d"]
    rows = rows.filter(F.size("v") == dims)

    # The query itself and k others: more copies of one vector can not be among its nearest.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    least = rows.select("v", "id").distinct().withColumn("place", place).filter(F.col("place") <= k + 1)
    kinds = least.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    kinds = store(kinds.withColumn("key", F.element_at("ids", 1)), "distinct-vectors")
    asked = rows.filter(F.coalesce("q", F.lit(False))).select("id", "v").distinct()
    asked = store(asked.join(kinds.select("v", "key"), "v").select(F.col("id").alias("query_id"), "key"), "queries")

    total = kinds.count()
    sample = sample_by_hash(kinds.select("key"), "key", max_sample)
    sample = kinds.join(F.broadcast(sample), "key").orderBy("key").select("v").toArrow()
    points = _unit(_matrix(sample.column(0).combine_chunks(), dims))
    lists = max(1, min(len(points) // sample_list, total // list_size))
    centroids = fit_centroids(points, lists)
    shared = spark.sparkContext.broadcast((centroids, graph(centroids)))

    def index():
        def work(vectors: list) -> tuple[list]:
            return (assign(shared.value[0], _unit(np.array(vectors, float)), replicas, replica_ratio),)

        return work

    def probe():
        def work(vectors: list) -> tuple[list]:
            return (lists_to_read(*shared.value, _unit(np.array(vectors, float)), ratio, typical / 2, full),)

        return work

    kind = [StructField("lists", ArrayType(LongType()), False)]
    held = append_columns(kinds.select("key", "v"), ["v"], kind, index)
    held = store(held.select("key", "v", F.explode("lists").alias("list")), "postings")
    keys = asked.select("key").distinct().join(kinds.select("key", "v"), "key")
    lengths = held.groupBy("list").agg(F.count("*").alias("n")).collect()
    full = np.zeros(len(centroids), bool)
    full[[r["list"] for r in lengths if r["n"] > k]] = True
    trial = sample_by_hash(keys, "key", max_trial).toArrow()
    names, asking = trial.column("key").to_numpy(), _matrix(trial.column("v").combine_chunks(), dims)
    away = distances(_unit(asking), centroids) if len(names) else np.ones((1, 1))
    # A query on a centroid would be within no ratio of others: count at least half of the usual distance.
    typical = float(np.median(away.min(1)))
    if ratio is None:
        true = _true_neighbours(kinds.select("key", "v"), names, asking, k)
        where = true.join(held.select("key", "list"), "key").groupBy("query", "key").agg(F.collect_list("list").alias("lists"))
        rows_of = {name: i for i, name in enumerate(names.tolist())}
        nearest_list = np.maximum(away.min(1), typical / 2)
        needed = [away[(i := rows_of[r["query"]]), r["lists"]].min() / nearest_list[i] for r in where.collect()]
        ratio = tuned(np.array(needed), recall)
    reads = append_columns(keys, ["v"], kind, probe)
    reads = store(reads.select(F.col("key").alias("query"), "v", F.explode("lists").alias("list")), "probes")

    # Blocks: lists and their readers are both cut by hash into parts of about ``block`` rows.
    sizes = held.groupBy("list").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    readers = reads.groupBy("list").agg(F.ceil(F.count("*") / block).cast("int").alias("q_parts"))
    cuts = small(store(sizes.join(readers, "list"), "blocks"))
    left = held.join(cuts, "list").select(
        "list", "key", "v", F.pmod(F.xxhash64("key"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("q_part"),
    )
    right = reads.join(cuts, "list").select(
        "list", "query", "v", F.pmod(F.xxhash64("query"), "q_parts").cast("int").alias("q_part"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    )

    def score(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        names = mine.column("key").to_numpy()
        asking = theirs.column("query").to_numpy()
        out: list[list] = [[], [], []]
        if len(names) and len(asking):
            order = np.argsort(names, kind="stable")
            a = _matrix(theirs.column("v").combine_chunks(), dims)
            b = _matrix(mine.column("v").combine_chunks(), dims)[order]
            names = names[order]
            scores = (a @ b.T) / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1))
            best = _best(scores, k + 1)
            out[0] = np.repeat(asking, best.shape[1])
            out[1] = names[best].ravel()
            out[2] = np.take_along_axis(scores, best, 1).ravel()
        return pa.table({"query": pa.array(out[0], pa.int64()), "key": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    where = ["list", "part", "q_part"]
    pairs = StructType([StructField("query", LongType()), StructField("key", LongType()), StructField("score", DoubleType())])
    found = left.groupBy(where).cogroup(right.groupBy(where)).applyInArrow(score, pairs)
    # A vector is in so many lists at most: among this many rows are k + 1 vectors, and tasks cut to them first.
    early = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))
    found = found.withColumn("place", early).filter(F.col("place") <= (k + 1) * replicas)
    found = found.groupBy("query", "key").agg(F.max("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))
    found = found.withColumn("place", best).filter(F.col("place") <= k + 1).select("query", "key", "score")
    found = store(found, "nearest")

    named = found.join(kinds.select("key", "ids"), "key").select("query", "score", F.explode("ids").alias("vec_id"))
    last = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    each = asked.withColumnRenamed("key", "query").join(named, "query").filter("vec_id != query_id")
    return each.withColumn("rank", last).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _true_neighbours(kinds: DataFrame, names: np.ndarray, asking: np.ndarray, k: int) -> DataFrame:
    """query, key: the ``k`` nearest others of a few vectors, compared with all; tasks hold the best of each so far."""
    shared = kinds.sparkSession.sparkContext.broadcast((names, _unit(asking)))
    pairs = StructType([StructField("query", LongType()), StructField("key", LongType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, asking = shared.value
        keys, best = np.empty((len(names), 0), np.int64), np.empty((len(names), 0))
        for batch in batches:
            mine = batch.column(0).to_numpy()
            scores = asking @ _unit(_matrix(batch.column(1), asking.shape[1])).T
            scores[names[:, None] == mine] = -np.inf
            best = np.concatenate([best, scores], 1)
            keys = np.concatenate([keys, np.broadcast_to(mine, scores.shape)], 1)
            top = _best(best, k)
            keys, best = np.take_along_axis(keys, top, 1), np.take_along_axis(best, top, 1)
        use = np.isfinite(best)
        query = np.broadcast_to(names[:, None], keys.shape)[use]
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(keys[use]), pa.array(best[use])], names=["query", "key", "score"])

    if not len(names):
        return kinds.sparkSession.createDataFrame([], "query long, key long")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))
    found = kinds.mapInArrow(run, pairs).withColumn("place", place)
    return found.filter(F.col("place") <= k).select("query", "key")


def _best(scores: np.ndarray, count: int) -> np.ndarray:
    """Columns of the ``count`` highest scores of each row, highest first; ties go to the first column."""
    if scores.shape[1] > 4 * count:
        least = np.partition(scores, -count, 1)[:, -count][:, None]
        # Ties with the last one are few, or else all columns are sorted.
        width = int((scores >= least).sum(1).max())
        if width <= 4 * count:
            some = np.sort(np.argpartition(-scores, width - 1, 1)[:, :width], 1)
            order = np.argsort(-np.take_along_axis(scores, some, 1), 1, kind="stable")[:, :count]
            return np.take_along_axis(some, order, 1)
    return np.argsort(-scores, 1, kind="stable")[:, :count]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(1, keepdims=True)
    vectors = vectors / scale
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
