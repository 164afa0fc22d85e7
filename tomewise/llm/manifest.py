"""Merkle manifest of a dataset: a root digest, and for every row the proof that it belongs to it.

Leaves are digests of rows. Within a group (here a language) they stand in order of their ids, and eight consecutive
nodes become one, level by level, until one node, the group's subroot, is left. Subroots in order of their groups become
the root in the same way.

Proofs come from pointer jumping: every node starts with the siblings of its own run as its segment and points to its
parent. A self-join lets each node take over its ancestor's pointer and append its ancestor's segment, which doubles
the distance; after a logarithmic number of rounds all point to the root. The leaves of one run share all but their own
siblings, so they take their step last and together, in one join of their run with its node.

Places are counted without a task for each group: rows are range-sorted by group, id and leaf, each task's rows of a
group are counted, and running sums of these counts say where its first row stands. Equal rows are one row with a
count until then. No node has more than eight children, so no join or grouping here has a hot key.

A null field is ``-``, any other its number of bytes, a colon and its value. Null ids and groups come first. Rows of
one id are in order of their leaves; repeated rows are leaves of their own, each with a proof. A row without id is not
tampered with. An empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomewise.llm.common import small, store

RUN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows that are sorted in one task.
RANGE_ROWS = 500_000


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column | None = None) -> Column:
    """Digest of a row, with its own text or another."""
    return _digest(*(_field(F.col(f) if f != "text" or text is None else text) for f in FIELDS))


def in_order(rows: DataFrame, group: str, order: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with ``place``, from 0 within each group by ``order``, and ``members``, the size of the group.

    Each row stands for ``n`` equal ones, of which ``place`` is the first's.
    """
    ranges = max(-(-rows.count() // range_rows), 1)
    # The number of its range is written with each row, so a lost task repeats it.
    ranged = store(
        rows.repartitionByRange(ranges, group, *order).withColumn("range", F.spark_partition_id()), "ranges"
    )
    sums = ranged.groupBy(group, "range").agg(F.sum("n").alias("in_range"))
    before = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = store(
        sums.select(
            F.col(group).alias("_group"),
            F.col("range").alias("_range"),
            F.coalesce(F.sum("in_range").over(before), F.lit(0)).alias("base"),
            F.sum("in_range").over(Window.partitionBy(group)).alias("members"),
        ),
        "bases",
    )
    above = Window.partitionBy("range", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("range") == F.col("_range"))
    return (
        ranged.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0)))
        .join(small(bases), same)
        .withColumn("place", F.col("base") + F.col("above"))
        .drop("range", "above", "_group", "_range", "base")
    )


def _parents(nodes: DataFrame) -> DataFrame:
    """Runs of nodes of one level as nodes of the next, with their ``children`` from left to right."""
    run = F.floor(F.col("place") / RUN).cast("bigint")
    children = F.transform(F.sort_array(F.collect_list(F.struct("place", "digest"))), lambda c: c["digest"])
    runs = nodes.groupBy("tree", run.alias("place")).agg(F.max("members").alias("members"), children.alias("children"))
    return runs.withColumn("digest", _digest(F.array_join(F.transform("children", _hex), ""))).withColumn(
        "members", F.ceil(F.col("members") / RUN)
    )


def _levels(nodes: DataFrame, members: int) -> list[DataFrame]:
    """Stored parents of ``nodes``, then theirs, up to a level where no tree has several nodes."""
    levels = []
    while members > 1:
        nodes = store(_parents(nodes.filter("members > 1")), f"level-{len(levels) + 1}")
        levels.append(nodes)
        members = -(-members // RUN)
    return levels


def _beside(children: str, i: Column) -> Column:
    """The siblings to the left and to the right of the child at ``i``."""
    return F.struct(
        F.slice(children, 1, i).alias("left"),
        F.slice(F.col(children), i + 2, F.lit(RUN)).alias("right"),
    )


def _jump(pointers: DataFrame, height: int) -> DataFrame:
    """``pointers`` followed to the root, in rounds that double their reach."""
    reach = 1
    while reach < height:
        ahead = pointers.select(
            F.col("tree").alias("up_tree"),
            F.col("level").alias("up_level"),
            F.col("place").alias("up_place"),
            F.struct("up_tree", "up_level", "up_place").alias("to"),
            F.col("path").alias("on"),
        )
        pointers = store(
            pointers.join(ahead, ["up_tree", "up_level", "up_place"], "left").select(
                "tree",
                "level",
                "place",
                *(F.coalesce(F.col("to")[c], F.col(c)).alias(c) for c in ("up_tree", "up_level", "up_place")),
                F.when(F.col("on").isNull(), F.col("path")).otherwise(F.concat("path", "on")).alias("path"),
            ),
            f"reach-{2 * reach}",
        )
        reach *= 2
    return pointers


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and its path of siblings lead to."""

    def up(node: Column, step: Column) -> Column:
        return _digest(
            F.array_join(F.transform(step["left"], _hex), ""), _hex(node), F.array_join(F.transform(step["right"], _hex), "")
        )

    return F.aggregate(path, digest, up)


def siblings(path: Column) -> Column:
    """Hex digests of a path, level by level, from left to right, as one text."""
    return F.array_join(F.flatten(F.transform(path, lambda s: F.transform(F.concat(s["left"], s["right"]), _hex))), "")


def manifest(
    docs: DataFrame,
    group: str = "lang",
    key: str = "doc_id",
    changed: Column | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``(key, leaf, subroot, root, path, presented)`` for each row: digests as binary, ``path`` with the siblings left
    and right of each node from the leaf to the root, and ``presented``, the leaf that a row with text ``changed`` has.
    """
    # Null where a row shows its own leaf, so that most texts are hashed once.
    other = F.when(~changed.eqNullSafe(F.col("text")), leaf(changed)) if changed is not None else F.lit(None).cast("binary")
    rows = docs.select(F.col(key).alias("key"), F.col(group).alias("group"), leaf().alias("leaf"), other.alias("presented"))
    kinds = store(rows.groupBy("key", "group", "leaf", "presented").agg(F.count(F.lit(1)).alias("n")), "leaves")
    placed = store(in_order(kinds, "group", ["key", "leaf"], range_rows), "placed")

    # A row for each group. Its number is its tree's, and its place among the subroots.
    groups = placed.groupBy("group").agg(F.max("members").alias("leaves")).withColumn("n", F.lit(1))
    groups = store(in_order(groups.withColumn("all", F.lit(0)), "all", ["group"], range_rows), "groups")
    n_groups, most = groups.agg(F.count(F.lit(1)), F.max("leaves")).head()
    if not n_groups:
        most = 0
    numbers = small(groups.select(F.col("group").alias("_group"), F.col("place").alias("tree")))
    leaves = (
        placed.join(numbers, F.col("group").eqNullSafe(F.col("_group")))
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
        .withColumn("place", F.col("place") + F.col("copy"))
    )
    # The first level keeps its rows, which take their step last.
    row = F.struct("place", "leaf", "key", "presented")
    runs = leaves.groupBy("tree", F.floor(F.col("place") / RUN).cast("bigint").alias("place")).agg(
        F.max("members").alias("leaves"), F.sort_array(F.collect_list(row)).alias("rows")
    )
    own = F.col("rows")["leaf"]
    joined = _digest(F.array_join(F.transform(own, _hex), ""))
    runs = store(
        runs.withColumn("digest", F.when(F.col("leaves") == 1, own[0]).otherwise(joined)).withColumn(
            "members", F.ceil(F.col("leaves") / RUN)
        ),
        "runs",
    )
    first = runs.select("tree", "place", "members", "digest")
    inner = _levels(first, -(-most // RUN))
    levels = [first, *inner]

    # Each tree's last node is its subroot, and a leaf of the tree above all.
    tops = reduce(
        DataFrame.unionByName,
        [
            nodes.filter("members = 1").select("tree", F.lit(level).alias("level"), "digest")
            for level, nodes in enumerate(levels, 1)
        ],
    )
    tops = store(tops, "subroots")
    crown = tops.select(
        F.lit(-1).cast("bigint").alias("tree"),
        F.col("tree").alias("place"),
        F.lit(n_groups).cast("bigint").alias("members"),
        "digest",
    )
    above = _levels(crown, n_groups)

    def children(parents: DataFrame, level: int) -> DataFrame:
        cut = parents.select("tree", "place", "children", F.posexplode("children").alias("i", "child"))
        return cut.select(
            "tree",
            F.lit(level).alias("level"),
            (F.col("place") * RUN + F.col("i")).alias("place"),
            F.col("tree").alias("up_tree"),
            F.lit(level + 1).alias("up_level"),
            F.col("place").alias("up_place"),
            F.array(_beside("children", F.col("i"))).alias("path"),
        )

    steps = [children(parents, level) for level, parents in enumerate(inner, 1)]
    steps += [children(parents, level) for level, parents in enumerate(above)]
    # A subroot and its leaf in the tree above are one node under two names.
    none = F.array().cast("array<struct<left: array<binary>, right: array<binary>>>")
    aliases = tops.select(
        "tree",
        "level",
        F.lit(0).cast("bigint").alias("place"),
        F.lit(-1).cast("bigint").alias("up_tree"),
        F.lit(0).alias("up_level"),
        F.col("tree").alias("up_place"),
        none.alias("path"),
    )
    pointers = reduce(DataFrame.unionByName, [aliases, *steps])
    reached = _jump(store(pointers, "reach-1"), len(inner) + 1 + len(above))

    root = (above[-1] if above else tops).select("digest").limit(1).scalar()
    subroots = small(tops.select("tree", F.col("digest").alias("subroot")))
    ways = reached.filter((F.col("level") == 1) & (F.col("tree") >= 0)).select("tree", "place", "path")
    met = runs.join(ways, ["tree", "place"]).join(subroots, "tree").withColumn("own", own)
    found = met.select("*", F.posexplode("rows").alias("i", "row"))
    step = F.when(F.col("leaves") == 1, none).otherwise(F.array(_beside("own", F.col("i"))))
    return found.select(
        F.col("row.key").alias(key),
        F.col("row.leaf").alias("leaf"),
        "subroot",
        root.alias("root"),
        F.concat(step, F.col("path")).alias("path"),
        F.coalesce("row.presented", "row.leaf").alias("presented"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """The manifest of documents and the proofs of their rows; where 3 divides the crc32 of the id, letters are folded."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = F.when(tampered, F.translate("text", CAPITALS, SMALL)).otherwise(F.col("text"))
    found = manifest(docs, changed=changed)
    # Untouched leaves lead to the root of the proof too, so all are folded alike.
    return found.withColumn("folded", fold(F.col("presented"), F.col("path"))).select(
        "doc_id",
        _hex(F.col("leaf")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"),
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        _hex(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


# Levels by recursion, siblings by a join of every leaf with the runs of its ancestors; written from the definitions.
_FIELDS = " || ".join(
    f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen(CAST({f} AS VARCHAR)) || ':' || {f} END" for f in FIELDS
)
# The checksum bit by bit, since DuckDB has no function for it.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
  [ascii(c)::BIGINT FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
    lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)))"""
ORACLE_SQL = f"""
WITH RECURSIVE shown AS (
  SELECT *, CASE WHEN {_CRC32} % 3 = 0 THEN translate(text, '{CAPITALS}', '{SMALL}') ELSE text END AS other
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256({_FIELDS}) AS leaf, sha256({_FIELDS.replace("text", "other")}) AS presented FROM shown
), placed AS (
  SELECT *, row_number() OVER () AS rid, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, place, leaf AS digest, n FROM placed
  UNION ALL
  SELECT lang, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (max(n) + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY lang, level, place // 8
), subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, place, digest, n FROM subroots
  UNION ALL
  SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (max(n) + 7) // 8
  FROM tops WHERE n > 1 GROUP BY level, place // 8
), runs AS (
  SELECT rid, 0 AS part, level, digest, s.place, p.place // CAST(8 ** level AS BIGINT) AS own
  FROM placed p JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.n > 1
    AND s.place // 8 = p.place // CAST(8 ** (level + 1) AS BIGINT)
  UNION ALL
  SELECT rid, 1, level, s.digest, s.place, r.place // CAST(8 ** level AS BIGINT)
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
    JOIN tops s ON s.n > 1 AND s.place // 8 = r.place // CAST(8 ** (level + 1) AS BIGINT)
), steps AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY part, level) AS step,
    coalesce(string_agg(digest, '' ORDER BY place) FILTER (place < own), '') AS before,
    coalesce(string_agg(digest, '' ORDER BY place) FILTER (place > own), '') AS after
  FROM runs GROUP BY rid, part, level
), folds AS (
  SELECT rid, 0 AS step, presented AS digest FROM placed
  UNION ALL
  SELECT f.rid, s.step, sha256(before || digest || after)
  FROM folds f JOIN steps s ON s.rid = f.rid AND s.step = f.step + 1
), proofs AS (
  SELECT rid, string_agg(before || after, '' ORDER BY step) AS proof FROM steps GROUP BY rid
), folded AS (
  SELECT rid, arg_max(digest, step) AS folded_root FROM folds GROUP BY rid
), root AS (
  SELECT digest AS root FROM tops WHERE n = 1
)
SELECT doc_id, leaf, r.digest AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
  JOIN folded USING (rid) LEFT JOIN proofs USING (rid), root"""
