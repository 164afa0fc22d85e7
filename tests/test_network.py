from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from tomewise.operators import network
from tomewise.plans.storage import store


@pytest.fixture(scope="module")
def rows():
    """Books of which one author has a third, with most years in two hot ones."""
    draw = random.Random(11)
    found = []
    for i in range(150):
        author = "Hot" if draw.random() < 0.33 else f"Author {draw.randint(1, 30):02}"
        year = draw.choice([1990, 1990, 2001, draw.randint(1960, 2010)])
        found.append((f"b{i}", author, year))
    found += [(f"s{i}", f"Single {i:02}", 1999) for i in range(30)]
    found.append(("late", "Latecomer", 2090))
    return found


@pytest.fixture(scope="module")
def books(spark, rows):
    return store(spark.createDataFrame(rows, "file_name string, author string, release_year int"), "b")


@pytest.fixture(scope="module")
def profiles(books):
    return store(network.author_profiles(books), "profiles")


@pytest.fixture(scope="module")
def edges(rows):
    return [
        (a, b, y, z, z - y)
        for _, a, y in rows
        for _, b, z in rows
        if a != b and 1 <= z - y <= 20
    ]


@pytest.fixture(scope="module")
def pairs(edges):
    gaps = defaultdict(list)
    for a, b, _, _, gap in edges:
        gaps[a, b].append(gap)
    return {(*at, len(g), min(g), max(g)) for at, g in gaps.items()}


def tuples(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(params=[(4096, 1024), (3, 1024), (2, 2)], ids=["whole", "chunks", "pieces"])
def sizes(request, monkeypatch):
    monkeypatch.setattr(network, "CHUNK_ROWS", request.param[0])
    monkeypatch.setattr(network, "PIECE_AUTHORS", request.param[1])


def test_book_edges(books, edges, sizes):
    assert Counter(tuples(network.book_edges(books))) == Counter(edges)


def test_author_edges(profiles, pairs, sizes):
    got = tuples(network.author_edges(profiles))
    assert len(got) == len(pairs) and set(got) == pairs


@pytest.mark.parametrize("limit", [0, 1 << 26], ids=["shuffled", "broadcast"])
def test_author_edges_with_names_looked_up(profiles, pairs, sizes, monkeypatch, limit):
    monkeypatch.setattr(network, "TASK_PAIRS", 50)
    got = tuples(network.author_edges(profiles, limit))
    assert len(got) == len(pairs) and set(got) == pairs


def test_totals(profiles, edges, pairs, sizes):
    assert tuple(network.influence_totals(profiles).head()) == (len(edges), len(pairs))


def test_degrees(profiles, pairs, sizes):
    out = Counter(a for a, *_ in pairs)
    into = Counter(b for _, b, *_ in pairs)
    assert dict(tuples(network.out_degree(profiles))) == out
    assert dict(tuples(network.in_degree(profiles))) == into
    metrics = tuples(network.author_metrics(profiles))
    assert sorted(metrics) == sorted((a, out[a], into[a]) for a in set(out) | set(into))
    assert sum(out.values()) == sum(into.values()) == len(pairs)


def test_degrees_with_years_far_apart(spark):
    """Authors with several windows, whose years spread over both centuries."""
    draw = random.Random(3)
    rows = [(f"A{i:02}", draw.randint(1900, 2099)) for i in range(60) for _ in range(draw.randint(1, 6))]
    books = spark.createDataFrame([(f"b{i}", *r) for i, r in enumerate(rows)], "file_name string, author string, release_year int")
    profiles = store(network.author_profiles(books), "profiles")
    met = {(a, b) for a, y in rows for b, z in rows if a != b and 1 <= z - y <= 20}
    pairs = sum(a != b and 1 <= z - y <= 20 for a, y in rows for b, z in rows)
    assert dict(tuples(network.out_degree(profiles))) == Counter(a for a, _ in met)
    assert dict(tuples(network.in_degree(profiles))) == Counter(b for _, b in met)
    assert tuple(network.influence_totals(profiles).head()) == (pairs, len(met))


@pytest.fixture(scope="module")
def spread_rows():
    """Authors with six books each: ten within a few years, the others in years over both centuries."""
    draw = random.Random(21)
    near = [(f"N{i}", 1950 + i + draw.randint(0, 6)) for i in range(10) for _ in range(6)]
    return near + [(f"A{i:03}", draw.randint(1900, 2099)) for i in range(80) for _ in range(6)]


@pytest.fixture(scope="module")
def spread_profiles(spark, spread_rows):
    books = spark.createDataFrame([(f"b{i}", *r) for i, r in enumerate(spread_rows)], "file_name string, author string, release_year int")
    return store(network.author_profiles(books), "profiles")


@pytest.mark.parametrize("cell", [4096, 7])
def test_degrees_in_cells(spread_rows, spread_profiles, monkeypatch, cell):
    monkeypatch.setattr(network, "CELL_SETS", cell)
    met = {(a, b) for a, y in spread_rows for b, z in spread_rows if a != b and 1 <= z - y <= 20}
    assert dict(tuples(network.out_degree(spread_profiles))) == Counter(a for a, _ in met)
    assert dict(tuples(network.in_degree(spread_profiles))) == Counter(b for _, b in met)


@pytest.mark.parametrize("heavy", [1, 8, 256])
def test_strongest_edges_of_authors_with_equal_numbers_of_books(spread_rows, spread_profiles, monkeypatch, heavy):
    compared = []
    whole = network.profile_edges

    def counted(profiles, late=None):
        compared.append((profiles.count(), (profiles if late is None else late).count()))
        return whole(profiles, late)

    monkeypatch.setattr(network, "profile_edges", counted)
    monkeypatch.setattr(network, "HEAVY_PROFILES", heavy)
    gaps = defaultdict(list)
    for a, y in spread_rows:
        for b, z in spread_rows:
            if a != b and 1 <= z - y <= 20:
                gaps[a, b].append(z - y)
    want = sorted(((*at, len(g), min(g), max(g)) for at, g in gaps.items()), key=lambda e: (-e[2], e[0], e[1]))[:5]
    assert tuples(network.strongest_edges(spread_profiles, 5)) == want
    # Once a floor is known, not all profiles are compared.
    if heavy == 8:
        assert compared[-1][0] * compared[-1][1] < 90 * 90 / 2


@pytest.mark.parametrize("k", [1, 3, 100])
def test_strongest_edges_per_author(profiles, pairs, k):
    want = set()
    for author in {a for a, *_ in pairs}:
        mine = sorted((e for e in pairs if e[0] == author), key=lambda e: (-e[2], e[1]))[:k]
        want |= {(author, i, *e[1:]) for i, e in enumerate(mine, 1)}
    got = tuples(network.strongest_edges_per_author(profiles, k))
    assert len(got) == len(want) and set(got) == want


def test_sketched_number_of_authors(spark):
    books = spark.range(60_000).selectExpr("concat('A', id % 20000) author")
    assert network.author_count(books).head()[0] == 20_000
    assert network.author_count(books, log_size=14).head()[0] == pytest.approx(20_000, rel=0.03)


def test_strongest_edges_from_few_heavy_profiles(profiles, pairs, monkeypatch):
    monkeypatch.setattr(network, "HEAVY_PROFILES", 3)
    want = sorted(pairs, key=lambda e: (-e[2], e[0], e[1]))[:5]
    assert tuples(network.strongest_edges(profiles, 5)) == want


@pytest.mark.parametrize("k", [1, 20, 400])
def test_closest_edges(books, edges, k):
    want = sorted(edges, key=lambda e: (e[4], e[0], e[1], e[2]))[:k]
    assert tuples(network.closest_edges(books, k)) == want


@pytest.mark.parametrize("k", [1, 20, 400])
def test_strongest_edges(profiles, pairs, k):
    want = sorted(pairs, key=lambda e: (-e[2], e[0], e[1]))[:k]
    assert tuples(network.strongest_edges(profiles, k)) == want


def test_strongest_edges_among_equals(spark):
    rows = [(f"b{i}{y}", f"A{i}", y) for i in range(6) for y in (1990, 1991)]
    books = spark.createDataFrame(rows, "file_name string, author string, release_year int")
    got = tuples(network.strongest_edges(network.author_profiles(books), 7))
    names = [f"A{i}" for i in range(6)]
    want = [(a, b, 1, 1, 1) for a in names for b in names if a != b][:7]
    assert got == want


def test_top_authors(profiles, pairs):
    out = Counter(a for a, *_ in pairs)
    into = Counter(b for _, b, *_ in pairs)
    by_out = sorted(set(out) | set(into), key=lambda a: (-out[a], a))[:5]
    by_in = sorted(set(out) | set(into), key=lambda a: (-into[a], a))[:5]
    metrics = store(network.author_metrics(profiles), "metrics")
    assert [r.author for r in network.top_out_degree(metrics).collect()] == by_out
    assert [r.author for r in network.top_in_degree(metrics).collect()] == by_in
    assert {r.author for r in network.top_authors(metrics).collect()} == {*by_out, *by_in}


def test_no_edges(spark):
    books = spark.createDataFrame(
        [("a", "A", 1990), ("b", "B", 1990), ("c", "A", 1995)],
        "file_name string, author string, release_year int",
    )
    profiles = network.author_profiles(books)
    assert tuples(network.author_edges(profiles)) == [("B", "A", 1, 5, 5)]
    lonely = network.author_profiles(books.filter("author = 'A'"))
    assert tuple(network.influence_totals(lonely).head()) == (0, 0)
    assert network.author_metrics(lonely).count() == 0


def test_completeness(spark):
    found = spark.createDataFrame(
        [("a", "A", 1990), ("b", None, 1990), ("c", "C", None)],
        "file_name string, author string, release_year int",
    )
    assert tuple(network.completeness(found).head()) == (1, 2)
    assert [r.file_name for r in network.complete_books(found).collect()] == ["a"]
