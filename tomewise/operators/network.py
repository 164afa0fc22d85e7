"""Influence of authors on later ones, from authors and release years.

``books`` here has ``(author, release_year)`` and one row per book with both.
Store it first, since extracting it reads every text and most functions here use
it more than once.

Author pairs are not compared one by one. Authors are grouped by profile, the
number of books they have in each year; influence between two profiles holds for
all their authors, so it is found once per pair of profiles, by an equi-join on
year. Degrees and totals need no pairs at all: they are sums over tables by year.
Only the author-level edge list itself spells out author pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomewise.functions import header
from tomewise.plans.storage import BROADCAST_BYTES, few_rows, fits_broadcast, store

MIN_GAP = 1
MAX_GAP = 20
# Years are cut out of text as 19xx or 20xx.
FIRST_YEAR, LAST_YEAR = 1900, 2099

# Rows of one side that meet in one task.
CHUNK_ROWS = 4096

# Authors of one profile that meet in one task.
PIECE_AUTHORS = 1024

# Author pairs that one task spells out on average, beyond the session's own number of partitions.
TASK_PAIRS = 16_000_000

# Profiles with the largest bounds that are compared first, for a floor of the strongest edges.
HEAVY_PROFILES = 256

# Sets of years, and sets of windows, that meet in one task.
CELL_SETS = 4096

# Years that one number holds as bits.
WORD_YEARS = 50


def authors_and_years(
    books: DataFrame, key: str = "file_name", text_col: str = "text"
) -> DataFrame:
    """``(key, author, release_year)`` of every book; NULL where not found."""
    text = F.col(text_col)
    fields = F.struct(
        header.author(text).alias("author"),
        header.release_year(text).alias("release_year"),
    )
    # As in the profile, inline keeps filters from repeating the matches.
    return books.select(key, F.inline(F.array(fields)))


def complete_books(found: DataFrame) -> DataFrame:
    return found.filter(F.col("author").isNotNull() & F.col("release_year").isNotNull())


def completeness(found: DataFrame) -> DataFrame:
    """One row: ``complete_books``, ``incomplete_books``."""
    complete = F.count_if(F.col("author").isNotNull() & F.col("release_year").isNotNull())
    return found.agg(
        complete.alias("complete_books"),
        (F.count(F.lit(1)) - complete).alias("incomplete_books"),
    )


def author_book_counts(books: DataFrame) -> DataFrame:
    return (
        books.groupBy("author")
        .agg(F.count(F.lit(1)).alias("book_count"))
        .orderBy(F.desc("book_count"), "author")
    )


def author_count(books: DataFrame, log_size: int | None = None) -> DataFrame:
    """``unique_authors``, exactly; with ``log_size`` by a sketch of at most ``2 ** log_size`` registers per task.

    Sketches are merged in place of names being shuffled; the standard error is about ``1.04 / 2 ** (log_size / 2)``.
    """
    if log_size is None:
        return books.agg(F.count_distinct("author").alias("unique_authors"))
    return books.agg(F.hll_sketch_estimate(F.hll_sketch_agg("author", log_size)).alias("unique_authors"))


def top_authors_by_books(books: DataFrame, k: int = 20) -> DataFrame:
    return author_book_counts(books).limit(k)


# --- the join on years ------------------------------------------------------


def _later_years(year: str) -> Column:
    """The years in which a book of ``year`` has influence, one per row."""
    return F.explode(F.sequence(F.col(year) + MIN_GAP, F.col(year) + MAX_GAP))


def _chunk(salt: Column, chunks: str) -> Column:
    return F.pmod(F.xxhash64(salt), F.col(chunks)).cast("int")


def _meet(early: DataFrame, late: DataFrame, early_salt: str, late_salt: str) -> DataFrame:
    """Join rows with a ``year_early`` to rows with a ``year_late`` 1 to 20 years on.

    Each early row is sent to its 20 later years, which makes an equi-join. A year
    may hold a third of all rows, so both sides of a year are cut into chunks and
    every two chunks meet under a key of their own. The numbers of chunks come
    from a table with a row per year. Years are cut out of text as 19xx or 20xx,
    so it has 200 rows at most and is broadcast. The two sides never are: a row of a
    short file stands for many here, and Spark guesses their size by that of the file.
    """
    per_year = late.groupBy("year_late").agg(F.count(F.lit(1)).alias("late_rows"))
    before = (
        early.groupBy("year_early")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(_later_years("year_early").alias("year_late"), "n")
        .groupBy("year_late")
        .agg(F.sum("n").alias("early_rows"))
    )
    grid = F.broadcast(
        per_year.join(before, "year_late").select(
            "year_late",
            F.ceil(F.col("early_rows") / CHUNK_ROWS).cast("int").alias("early_chunks"),
            F.ceil(F.col("late_rows") / CHUNK_ROWS).cast("int").alias("late_chunks"),
        )
    )
    left = (
        early.select("*", _later_years("year_early").alias("year_late"))
        .withColumn("year_gap", F.col("year_late") - F.col("year_early"))
        .join(grid, "year_late")
        .withColumn("early_chunk", _chunk(F.col(early_salt), "early_chunks"))
        .withColumn("late_chunk", F.explode(F.sequence(F.lit(0), F.col("late_chunks") - 1)))
        .drop("early_chunks", "late_chunks")
    )
    right = (
        late.join(grid, "year_late")
        .withColumn("late_chunk", _chunk(F.col(late_salt), "late_chunks"))
        .withColumn("early_chunk", F.explode(F.sequence(F.lit(0), F.col("early_chunks") - 1)))
        .drop("early_chunks", "late_chunks")
    )
    return left.join(right.hint("merge"), ["year_late", "early_chunk", "late_chunk"])


def book_edges(books: DataFrame, key: str = "file_name") -> DataFrame:
    """``(influencer, influenced, year_early, year_late, year_gap)`` per book pair."""
    early = books.select(
        F.col("author").alias("influencer"),
        F.col("release_year").alias("year_early"),
        F.col(key).alias("early_book"),
    )
    late = books.select(
        F.col("author").alias("influenced"),
        F.col("release_year").alias("year_late"),
        F.col(key).alias("late_book"),
    )
    return (
        _meet(early, late, "early_book", "late_book")
        .filter(F.col("influencer") != F.col("influenced"))
        .select("influencer", "influenced", "year_early", "year_late", "year_gap")
    )


def closest_edges(books: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` book edges with the smallest gap, then by author names and year.

    Only the first ``k + 1`` names of a year can be in the answer: for a later
    name there are ``k`` earlier ones that, in its place, make smaller edges. So
    the join sees a few thousand rows whatever the number of authors.
    """
    by_name = Window.partitionBy("release_year").orderBy("author")
    first = (
        books.groupBy("author", "release_year")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("place", F.row_number().over(by_name))
        .filter(F.col("place") <= k + 1)
    )
    early = first.select(
        F.col("author").alias("influencer"),
        F.col("release_year").alias("year_early"),
        F.col("n").alias("n_early"),
        _later_years("release_year").alias("year_late"),
    ).withColumn("year_gap", F.col("year_late") - F.col("year_early"))
    late = first.select(
        F.col("author").alias("influenced"),
        F.col("release_year").alias("year_late"),
        F.col("n").alias("n_late"),
    )
    order = ["year_gap", "influencer", "influenced", "year_early"]
    pairs = early.join(late, "year_late").filter(F.col("influencer") != F.col("influenced"))
    # One row per pair of books, as far as k of them reach.
    books_met = F.least(F.col("n_early").cast("double") * F.col("n_late"), F.lit(float(k)))
    return (
        pairs.orderBy(*order)
        .limit(k)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), books_met.cast("int"))))
        .orderBy(*order)
        .limit(k)
        .select("influencer", "influenced", "year_early", "year_late", "year_gap")
    )


# --- profiles ---------------------------------------------------------------


def author_profiles(books: DataFrame) -> DataFrame:
    """``(author, profile, years)``; years with their numbers of books, in order.

    There is one entry per year, so 200 at most. ``profile`` is a digest of them,
    which is shorter to shuffle and compare. The functions below take this table;
    store it first.
    """
    per_year = books.groupBy("author", "release_year").agg(F.count(F.lit(1)).alias("n"))
    years = F.sort_array(F.collect_list(F.struct("release_year", "n")))
    digest = F.unhex(F.sha2(F.to_json("years"), 256))
    return per_year.groupBy("author").agg(years.alias("years")).withColumn("profile", digest)


def profile_edges(profiles: DataFrame, late: DataFrame | None = None) -> DataFrame:
    """One row per pair of profiles of which the first influences the second.

    ``early`` and ``late`` are the profiles, ``early_authors`` and
    ``late_authors`` their numbers of authors, ``early_first`` and ``late_first``
    their first authors by name; ``num_connections``, ``min_year_gap`` and
    ``max_year_gap`` hold for any one author of each. Authors of a profile that is
    paired with itself influence each other, but nobody themselves. Profiles on the
    second side are those of ``late``, if it is given; it has all authors of each.
    """

    def by_year(profiles: DataFrame) -> DataFrame:
        kinds = profiles.groupBy("profile", "years").agg(F.count(F.lit(1)).alias("authors"), F.min("author").alias("first"))
        return store(kinds.select("profile", "authors", "first", F.inline("years")), "profile-years")

    years = by_year(profiles)

    def side(years: DataFrame, name: str) -> DataFrame:
        return years.select(
            F.col("profile").alias(name),
            F.col("authors").alias(f"{name}_authors"),
            F.col("first").alias(f"{name}_first"),
            F.col("release_year").alias(f"year_{name}"),
            F.col("n").alias(f"n_{name}"),
        )

    only_oneself = (F.col("early") == F.col("late")) & (F.col("early_authors") == 1)
    return (
        _meet(side(years, "early"), side(years if late is None else by_year(late), "late"), "early", "late")
        .filter(~only_oneself)
        .groupBy("early", "late")
        .agg(
            *[F.max(c).alias(c) for c in ("early_authors", "late_authors")],
            *[F.min(c).alias(c) for c in ("early_first", "late_first")],
            F.sum(F.col("n_early") * F.col("n_late")).alias("num_connections"),
            F.min("year_gap").alias("min_year_gap"),
            F.max("year_gap").alias("max_year_gap"),
        )
    )


def _other_authors(edge_authors: str) -> Column:
    """Number of authors of one side without the author on the other side."""
    return F.col(edge_authors) - (F.col("early") == F.col("late")).cast("int")


def _pieces(authors: Column) -> Column:
    """Into how many pieces the authors of a profile are cut, so that none has many more than its bound."""
    return F.ceil(authors / PIECE_AUTHORS).cast("int")


def _members(profiles: DataFrame) -> DataFrame:
    """``(profile, piece, authors)``: the names of a profile in lists; large profiles are looked up, and only they are cut."""
    sizes = profiles.groupBy("profile").agg(F.count(F.lit(1)).alias("authors"))
    cut = sizes.select("profile", _pieces(F.col("authors")).alias("pieces")).filter(F.col("pieces") > 1)
    pieces = F.pmod(F.xxhash64("author"), F.coalesce("pieces", F.lit(1))).cast("int").alias("piece")
    return profiles.join(cut, "profile", "left").groupBy("profile", pieces).agg(F.collect_list("author").alias("authors"))


def _numbers_to(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), count - 1))


def author_edges(profiles: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(influencer, influenced, num_connections, min_year_gap, max_year_gap)``.

    Author pairs come straight out of profile pairs and are not shuffled. Large
    profiles are cut in pieces, and every two pieces meet in a cell of their own.
    A cell looks its two lists of names up and spells their pairs out; while all
    names fit they are broadcast, and cells are dealt to tasks by number of all pairs.
    """
    numbers = ["num_connections", "min_year_gap", "max_year_gap"]
    members = store(_members(profiles), "members")
    # Without the first names, whose minimum Spark finds by sorting all rows.
    edges = store(
        profile_edges(profiles).select("early", "late", "early_authors", "late_authors", *numbers), "profile-edges"
    )
    cells = edges.withColumn("early_piece", _numbers_to(_pieces(F.col("early_authors")))).withColumn(
        "late_piece", _numbers_to(_pieces(F.col("late_authors")))
    )
    cell = ["early", "early_piece", "late", "late_piece"]

    def side(name: str) -> DataFrame:
        return members.select(
            F.col("profile").alias(name), F.col("piece").alias(f"{name}_piece"), F.col("authors").alias(f"{name}_names")
        )

    if fits_broadcast(profiles, "author", broadcast_bytes):
        pairs = edges.agg(F.sum(F.col("early_authors").cast("double") * F.col("late_authors"))).head()[0] or 0
        tasks = max(int(profiles.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(pairs // TASK_PAIRS))
        met = (
            cells.select(*cell, *numbers)
            .repartition(tasks, *cell)
            .join(F.broadcast(side("early")), ["early", "early_piece"])
            .join(F.broadcast(side("late")), ["late", "late_piece"])
        )
    else:
        left = cells.select(*cell, *numbers).join(side("early"), ["early", "early_piece"])
        right = cells.select(*cell).join(side("late"), ["late", "late_piece"])
        met = left.join(right, cell)
    return (
        met.select(F.explode("early_names").alias("influencer"), "late_names", *numbers)
        .select("influencer", F.explode("late_names").alias("influenced"), *numbers)
        .filter(F.col("influencer") != F.col("influenced"))
    )


def edges_of_author(books: DataFrame, author: str) -> DataFrame:
    """The author edges from or to one author: their years meet all others, and no other pair is made."""
    per_year = books.groupBy("author", "release_year").agg(F.count(F.lit(1)).alias("n"))
    # A row per year of one author, 200 at most.
    mine = per_year.filter(F.col("author") == F.lit(author)).select(
        F.col("release_year").alias("mine"), F.col("n").alias("n_mine")
    )
    met = mine.select("mine", "n_mine", F.explode(F.sequence(F.col("mine") - MAX_GAP, F.col("mine") + MAX_GAP)).alias("release_year"))
    gap = F.col("release_year") - F.col("mine")
    edges = (
        per_year.filter(F.col("author") != F.lit(author))
        .join(F.broadcast(met.filter(F.abs(gap).between(MIN_GAP, MAX_GAP))), "release_year")
        .select(
            F.when(gap > 0, F.lit(author)).otherwise(F.col("author")).alias("influencer"),
            F.when(gap > 0, F.col("author")).otherwise(F.lit(author)).alias("influenced"),
            (F.col("n") * F.col("n_mine")).alias("met"),
            F.abs(gap).alias("gap"),
        )
    )
    return edges.groupBy("influencer", "influenced").agg(
        F.sum("met").alias("num_connections"), F.min("gap").alias("min_year_gap"), F.max("gap").alias("max_year_gap")
    )


def influence_totals(profiles: DataFrame) -> DataFrame:
    """One row: numbers of book edges and of author edges, without building them.

    Book edges are pairs of books 1 to 20 years apart, a sum over two years' numbers of books, less those of one
    author. Author edges are the sum of all out-degrees.
    """
    per_year = profiles.select(F.inline("years")).groupBy("release_year").agg(F.sum("n").alias("n"))
    # A row per year, 200 at most.
    later = per_year.select(F.col("release_year").alias("year_late"), F.col("n").alias("n_late"))
    all_pairs = (
        per_year.select(F.col("n").alias("n_early"), _later_years("release_year").alias("year_late"))
        .join(F.broadcast(later), "year_late")
        .agg(F.coalesce(F.sum(F.col("n_early") * F.col("n_late")), F.lit(0)).alias("all_pairs"))
    )
    own = F.aggregate(
        "years",
        F.lit(0).cast("bigint"),
        lambda total, early: total
        + early["n"]
        * F.aggregate(
            F.filter("years", lambda late: _in_reach(late["release_year"] - early["release_year"])),
            F.lit(0).cast("bigint"),
            lambda n, late: n + late["n"],
        ),
    )
    own_pairs = profiles.agg(F.coalesce(F.sum(own), F.lit(0)).alias("own_pairs")).scalar()
    authors = out_degree(profiles).agg(F.coalesce(F.sum("out_degree"), F.lit(0)).alias("n")).scalar()
    return all_pairs.select(
        (F.col("all_pairs") - own_pairs).alias("book_edges"), authors.alias("author_edges")
    )


def _books(years: Column, fits=lambda y: F.lit(True)) -> Column:
    """Number of an author's books in the years that fit."""
    return F.aggregate(F.filter(years, lambda y: fits(y["release_year"])), F.lit(0).cast("bigint"), lambda n, y: n + y["n"])


def _most_met(kinds: DataFrame, first: int, last: int) -> Column:
    """By year: the most books that one author has from ``first`` to ``last`` years on; an array of 200 numbers."""
    offset = F.explode(F.sequence(F.lit(-last), F.lit(-first)))
    met = (
        kinds.select("years", F.explode("years.release_year").alias("z"))
        .select("years", "z", offset.alias("offset"))
        .select("years", (F.col("z") + F.col("offset")).alias("y"))
        .filter(F.col("y").between(FIRST_YEAR, LAST_YEAR))
        .groupBy("y")
        .agg(F.max(_books(F.col("years"), lambda z: (z - F.col("y")).between(first, last))).alias("most"))
    )
    # A row per year.
    most = {r["y"]: r["most"] for r in met.collect()}
    return F.array(*(F.lit(most.get(y, 0)).cast("bigint") for y in range(FIRST_YEAR, LAST_YEAR + 1)))


def _bounded(profiles: DataFrame) -> tuple[DataFrame, int, int]:
    """Stored profiles with bounds on the connections of their strongest edges, and the largest of two of them.

    An author's books meet at most ``most_met`` books of one author each, so ``as_early`` and ``as_late`` are bounds.
    All the books that one book meets lie within 20 years, so an edge also has at most the books of the one author
    times the most books that the other has within 20 years, ``books`` times ``dense``.
    """
    kinds = store(profiles.groupBy("profile", "years").agg(F.count(F.lit(1)).alias("authors")), "kinds")

    def bound(most: Column) -> Column:
        return F.aggregate(
            "years", F.lit(0).cast("bigint"), lambda total, y: total + y["n"] * F.get(most, y["release_year"] - FIRST_YEAR)
        )

    span = MAX_GAP - MIN_GAP
    dense = F.array_max(
        F.transform("years", lambda y: _books(F.col("years"), lambda z: (z - y["release_year"]).between(0, span)))
    )
    sized = store(
        kinds.select(
            "profile",
            "authors",
            bound(_most_met(kinds, MIN_GAP, MAX_GAP)).alias("as_early"),
            bound(_most_met(kinds, -MAX_GAP, -MIN_GAP)).alias("as_late"),
            _books(F.col("years")).alias("books"),
            dense.alias("dense"),
        ),
        "bounds",
    )
    books, densest = sized.agg(F.max("books"), F.max("dense")).head()
    return sized, books or 0, densest or 0


def strongest_edges(profiles: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` author edges with the most connections, then by author names.

    All edges of a profile pair have equal connections and the smallest names
    come first. So only the best ``k`` profile pairs, by their best edge, and the
    first ``k + 1`` authors of a profile can be in the answer.

    Profiles are compared best bound first: the ``k``-th best edge among those with
    the largest bounds is a floor, and profiles that can not reach it are dropped.
    That is repeated with four times as many until no more are left than that.
    """
    sized, books, densest = _bounded(profiles)
    take, floor = HEAVY_PROFILES, 0
    while True:
        reach = (F.col("books") * densest >= floor) & (F.col("dense") * books >= floor)
        early = sized.filter(reach & (F.col("as_early") >= floor))
        late = sized.filter(reach & (F.col("as_late") >= floor))
        left = max(early.count(), late.count())
        if left <= take:
            break

        def heads(kinds: DataFrame, bound: str) -> DataFrame:
            best = kinds.orderBy(F.desc(bound), F.desc("dense"), "profile").limit(take).select("profile")
            return profiles.join(few_rows(store(best, "heads")), "profile", "left_semi")

        pairs = F.col("early_authors") * _other_authors("late_authors")
        edges = profile_edges(heads(early, "as_early"), heads(late, "as_late"))
        best = edges.withColumn("edges", pairs).orderBy(F.desc("num_connections")).limit(k)
        rows = best.agg(F.min("num_connections").alias("floor"), F.sum("edges").alias("edges")).head()
        if rows["edges"] is not None and rows["edges"] >= k:
            floor = rows["floor"]
        take *= 4

    def kept(kinds: DataFrame) -> DataFrame:
        return profiles.join(few_rows(kinds.select("profile")), "profile", "left_semi")

    edges = store(profile_edges(kept(early), kept(late)), "profile-edges")
    order = [F.desc("num_connections"), "early_first", "late_first"]
    # The best edge of a profile with itself is not that of its first author
    # twice, so the two kinds are ranked apart.
    within = F.col("early") == F.col("late")
    heads = (
        edges.filter(~within)
        .orderBy(*order)
        .limit(k)
        .unionByName(edges.filter(within).orderBy(*order).limit(k))
    )
    by_name = Window.partitionBy("profile").orderBy("author")
    first = profiles.withColumn("place", F.row_number().over(by_name)).filter(
        F.col("place") <= k + 1
    )
    return (
        heads.join(first.select(F.col("profile").alias("early"), "author"), "early")
        .withColumnRenamed("author", "influencer")
        .join(first.select(F.col("profile").alias("late"), "author"), "late")
        .withColumnRenamed("author", "influenced")
        .filter(F.col("influencer") != F.col("influenced"))
        .select("influencer", "influenced", "num_connections", "min_year_gap", "max_year_gap")
        .orderBy(F.desc("num_connections"), "influencer", "influenced")
        .limit(k)
    )


def strongest_edges_per_author(profiles: DataFrame, k: int = 5) -> DataFrame:
    """``(influencer, rank, influenced, num_connections, min_year_gap, max_year_gap)``: each author's ``k`` strongest
    edges to later authors, then by name.

    Authors of one profile have the same edges but for themselves, so a profile's ``k + 1`` first edges serve all its
    authors. They lie in its ``k + 1`` best pairs of profiles, and among the first ``k + 1`` authors of each; both are
    cut per task before they are shuffled, and the result is linear in the authors.
    """
    best = Window.partitionBy("early").orderBy(F.desc("num_connections"), "late_first")
    pairs = profile_edges(profiles).withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    by_name = Window.partitionBy("profile").orderBy("author")
    first = profiles.withColumn("place", F.row_number().over(by_name)).filter(F.col("place") <= k + 1)
    named = pairs.join(first.select(F.col("profile").alias("late"), F.col("author").alias("influenced")), "late")
    order = Window.partitionBy("early").orderBy(F.desc("num_connections"), "influenced")
    edge = F.struct("influenced", "num_connections", "min_year_gap", "max_year_gap")
    # At most k + 1 edges for a profile.
    lists = (
        named.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k + 1)
        .groupBy(F.col("early").alias("profile"))
        .agg(F.sort_array(F.collect_list(F.struct("place", edge.alias("edge")))).alias("edges"))
    )
    mine = F.slice(F.filter("edges", lambda e: e["edge"]["influenced"] != F.col("author")), 1, k)
    # A profile of many authors is on the side that is shuffled or broadcast once.
    return (
        profiles.select("author", "profile")
        .join(lists, "profile")
        .select(F.col("author").alias("influencer"), F.posexplode(mine).alias("i", "e"))
        .select("influencer", (F.col("i") + 1).alias("rank"), "e.edge.*")
    )


# --- degrees ----------------------------------------------------------------


def _in_reach(gap: Column) -> Column:
    return gap.between(MIN_GAP, MAX_GAP)


def _windows(shift_first: int, shift_last: int) -> Column:
    """The years of influence of an author as intervals ``(l, r)``, in order.

    Books at most 20 years apart have windows without a gap, so each run of such years is one interval.
    """
    years = F.col("years")
    run = MAX_GAP - MIN_GAP + 1

    def year(i: Column) -> Column:
        return F.get(years, i)["release_year"]

    firsts = F.filter(years, lambda y, i: (i == 0) | (y["release_year"] - year(i - 1) > run))
    lasts = F.filter(years, lambda y, i: (i == F.size(years) - 1) | (year(i + 1) - y["release_year"] > run))
    return F.zip_with(
        firsts,
        lasts,
        lambda a, b: F.struct(
            (a["release_year"] + shift_first).alias("l"), (b["release_year"] + shift_last).alias("r")
        ),
    )


def _degrees(profiles: DataFrame, name: str, shift_first: int, shift_last: int) -> DataFrame:
    """``(author, name)``: how many other authors have a book in an author's window; authors with none are absent.

    For one interval [l, r]: of the authors with a book in it, each has one first book in it, whose year is y and
    whose author's year before is p < l <= y <= r. So authors are counted per (p, y), at most 200 by 200 rows, and
    an interval's number is a sum over them. Of the authors with several intervals, different sets of windows are held
    against different sets of years, both as bits.
    """
    authors = store(
        profiles.select("author", "years", _windows(shift_first, shift_last).alias("windows")).withColumn(
            "years", F.transform("years", lambda y: y["release_year"])
        ),
        "author-windows",
    )
    itself = F.exists(
        "years",
        lambda y: F.exists("years", lambda z: (z - y >= MIN_GAP) & (z - y <= MAX_GAP)),
    ).cast("bigint")

    steps = F.transform("years", lambda y, i: F.struct(F.get("years", i - 1).alias("p"), y.alias("y")))
    counted = authors.select(F.inline(steps)).groupBy("p", "y").agg(F.count(F.lit(1)).alias("n"))
    # The first year of all is 1900, so no window starts before 1880.
    after = F.greatest(F.coalesce(F.col("p") + 1, F.lit(0)), F.lit(FIRST_YEAR - MAX_GAP))
    starts = counted.select(F.explode(F.sequence(after, "y")).alias("l"), "y", "n").groupBy("l", "y").agg(F.sum("n").alias("n"))

    one = authors.filter(F.size("windows") == 1).select("author", F.element_at("windows", 1).alias("w"), itself.alias("itself"))
    one = one.select("author", "w.l", "w.r", "itself")
    # A row per interval: fewer than 220 by 220.
    found = (
        one.select("l", "r").distinct().join(F.broadcast(starts), "l").filter("y between l and r")
        .groupBy("l", "r").agg(F.sum("n").alias("n"))
    )
    simple = one.join(F.broadcast(found), ["l", "r"]).select("author", (F.col("n") - F.col("itself")).alias(name))

    several = authors.filter(F.size("windows") > 1).withColumn(
        "open_years", F.flatten(F.transform("windows", lambda w: F.sequence(w["l"], w["r"])))
    )
    several = store(several.select("author", *_year_bits("open_years"), itself.alias("itself")), "several-windows")
    rest = several.join(_hits(several, authors), YEAR_BITS).select("author", (F.col("n") - F.col("itself")).alias(name))
    return simple.unionByName(rest).filter(F.col(name) > 0)


YEAR_BITS = [f"years_{i}" for i in range(-(-(LAST_YEAR - FIRST_YEAR + 1) // WORD_YEARS))]


def _year_bits(years: str) -> list[Column]:
    """A list of years as bits in a few numbers; years without books are not held."""
    return [
        F.expr(
            f"aggregate(filter({years}, y -> floor((y - {FIRST_YEAR}) / {WORD_YEARS}) = {i}), 0L,"
            f" (bits, y) -> bits | shiftleft(1L, (y - {FIRST_YEAR}) % {WORD_YEARS}))"
        ).alias(name)
        for i, name in enumerate(YEAR_BITS)
    ]


def _hits(several: DataFrame, authors: DataFrame) -> DataFrame:
    """``(years_0, ..., n)``: for each different set of windows, how many authors have a book in one of its years.

    Different sets of windows meet different sets of years in a grid of cells of bounded size, and each two are compared
    as bits. Numbers are summed in the task of the cell.
    """
    windows = store(several.select(*YEAR_BITS).distinct(), "window-sets")
    years = store(authors.select(*_year_bits("years")).groupBy(*YEAR_BITS).agg(F.count(F.lit(1)).alias("n")), "year-sets")
    rows, columns = (max(-(-df.count() // CELL_SETS), 1) for df in (windows, years))
    cells = ["row", "column"]

    def piece(pieces: int) -> Column:
        return F.pmod(F.xxhash64(*YEAR_BITS), F.lit(pieces)).cast("int")

    left = windows.withColumn("row", piece(rows)).withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    right = years.select(*(F.col(c).alias(f"of_{c}") for c in YEAR_BITS), "n", piece(columns).alias("column")).withColumn(
        "row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))
    )
    common = [F.col(c).bitwiseAND(F.col(f"of_{c}")) for c in YEAR_BITS]
    shared = common[0]
    for bits in common[1:]:
        shared = shared.bitwiseOR(bits)
    return left.join(right, cells).filter(shared != 0).groupBy(*YEAR_BITS).agg(F.sum("n").alias("n"))


def out_degree(profiles: DataFrame) -> DataFrame:
    """``(author, out_degree)``: how many authors each author influences."""
    return _degrees(profiles, "out_degree", MIN_GAP, MAX_GAP)


def in_degree(profiles: DataFrame) -> DataFrame:
    """``(author, in_degree)``: how many authors influence each author."""
    return _degrees(profiles, "in_degree", -MAX_GAP, -MIN_GAP)


def author_metrics(profiles: DataFrame) -> DataFrame:
    """``(author, out_degree, in_degree)`` of authors with an edge, 0 for none."""
    both = out_degree(profiles).join(in_degree(profiles), "author", "full_outer")
    return both.select("author", "out_degree", "in_degree").fillna(0, ["out_degree", "in_degree"])


def top_out_degree(metrics: DataFrame, k: int = 5) -> DataFrame:
    return metrics.orderBy(F.desc("out_degree"), "author").limit(k)


def top_in_degree(metrics: DataFrame, k: int = 5) -> DataFrame:
    return metrics.orderBy(F.desc("in_degree"), "author").limit(k)


def top_authors(metrics: DataFrame, k: int = 5) -> DataFrame:
    """Authors among the first ``k`` by either degree; store ``metrics`` first."""
    return top_out_degree(metrics, k).union(top_in_degree(metrics, k)).distinct()
