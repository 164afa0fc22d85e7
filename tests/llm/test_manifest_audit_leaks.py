"""Manifest, filter audit and decontamination against brute force on small texts with odd rows, and against SQL."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import SCHEMA, frame, odd_rows, sentence
from tests.oracle import compare, connect
from tomewise.llm import decontaminate, filter_audit, manifest
from tomewise.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_manifest", "op12_filter_audit", "op13_decontamination"])
def test_query_equals_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == ""


# --- manifest ----------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes, proofs):
    """The root of nodes; ``proofs`` gets, per first node, lists of (left, right)."""
    ways = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        ups, up_ways = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for i in range(len(run)):
                for leaf in ways[at + i]:
                    proofs[leaf].append((run[:i], run[i + 1 :]))
            ups.append(H(*run))
            up_ways.append([leaf for w in ways[at : at + 8] for leaf in w])
        nodes, ways = ups, up_ways
    return nodes[0]


def expected_manifest(rows):
    def leaf(row, text):
        doc_id, _, lang, source, n_chars = row
        values = (doc_id, source, lang, n_chars, text)
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    trees = defaultdict(list)
    for row in rows:
        doc_id, text = row[:2]
        folded = text
        if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            folded = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        trees[row[2]].append((doc_id, leaf(row, text), leaf(row, folded)))
    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    subroots, below = [], []
    for lang in order:
        trees[lang].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        proofs = defaultdict(list)
        subroots.append(climb([t[1] for t in trees[lang]], proofs))
        below.append(proofs)
    above = defaultdict(list)
    root = climb(subroots, above)
    found = Counter()
    for g, lang in enumerate(order):
        for i, (doc_id, own, shown) in enumerate(trees[lang]):
            path = below[g][i] + above[g]
            node = shown
            for left, right in path:
                node = H(*left, node, *right)
            siblings = [d for left, right in path for d in (*left, *right)]
            found[doc_id, own, subroots[g], root, H(*siblings), node, node == root] += 1
    return found


def leaves(n, langs, seed):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        text = draw.choice([None, "", "lower only", "Some Capitals É", "x" * 3000, "Ω\n\t" + sentence(draw, 3).title()])
        rows.append((draw.choice([i, i, None, 7]), text, draw.choice(langs), draw.choice(["s", None]), draw.choice([None, 3])))
    return rows + rows[: n // 5]


MANY_LANGS = [chr(97 + i % 26) * (i // 26 + 1) for i in range(70)]


@pytest.mark.parametrize(
    "n, langs, range_rows",
    [
        (1, ["a"], 500_000),
        (9, ["a"], 7),
        (400, ["a", "a", "a", None, "", "é"], 500_000),
        (400, ["a", "a", "a", None, "", "é"], 30),
        (90, MANY_LANGS, 7),
    ],
)
def test_manifest_equals_trees(spark, n, langs, range_rows, monkeypatch):
    place = manifest.in_order
    monkeypatch.setattr(manifest, "in_order", lambda rows, group, order, _: place(rows, group, order, range_rows))
    rows = leaves(n, langs, n)
    df = spark.createDataFrame([(*r, 1, 0.5, 2) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, place int, members double, tree int")
    got = Counter(tuple(r) for r in manifest.digest(df.repartition(3)).collect())
    assert got == expected_manifest(rows)


def test_manifest_of_no_rows(spark):
    assert manifest.digest(frame(spark, [])).count() == 0


def test_a_root_changes_with_any_row(spark):
    rows = [(i, f"text {i}", "aa") for i in range(20)]
    roots = set()
    for i in range(3):
        rows[i] = (i, "other", "aa")
        roots.add(manifest.manifest(frame(spark, rows)).head().root)
    assert len(roots) == 3


# --- filter audit ------------------------------------------------------------


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
        "D": any(c in "#$%&*|" for c in text),
    }


def expected_audit(rows, labels):
    found = {}
    texts = [(doc_id, text or "", source or "") for doc_id, text, source in rows]
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    marked = []
    for doc_id, text, part in texts:
        flags = fails(text)
        flags["E"] = doc_id is not None and any(o is not None and o < doc_id and t == text for o, t, _ in texts)
        marked.append((doc_id, part, {k for k, v in flags.items() if v}))
    for part in {p for _, _, p in texts}:
        mine = [(d, f) for d, p, f in marked if p == part]
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                removed = [d for d, f in left if letter in f]
                gone = len([1 for _, f in mine if letter in f]) - len(removed)
                left = [(d, f) for d, f in left if letter not in f]
                alone = len([1 for _, f in mine if f == {letter}])
                shapley[letter] += len(removed)
                found[part, order, step] = [
                    len(left), len(removed), gone, alone, sum(d in good for d in removed), sum(d in toxic for d in removed)
                ]
        for (p, order, step), numbers in found.items():
            if p == part:
                numbers.append(shapley[order[step - 1]])
    return {(*at, *numbers) for at, numbers in found.items()}


@pytest.mark.parametrize("piece_rows", [4096, 2])
def test_audit_equals_brute_force(spark, piece_rows):
    draw = random.Random(2)
    texts = [sentence(draw, n, "abAB#"[: draw.choice([2, 3, 5])]) for n in (5, 150, 250, 300, 400)]
    texts += [" ".join(f"w{i}" for i in range(250)), " ".join(["same"] * 220), "", None, "x" * 9000, " \t\x0b"]
    # A third of the rows are copies of one text.
    rows = [(draw.choice([i, i, i, None, 3]), draw.choice([*texts, *texts, *[texts[5]] * 9]), draw.choice(["s", "t", "t", "", None])) for i in range(120)]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 0, 1, None])) for i in (*range(0, 120, 2), 4, 4, None)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, n int, failures int").repartition(4)
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit(docs, marks, piece_rows).collect()
    assert len(got) == 600 * 3
    assert {tuple(r) for r in got} == expected_audit(rows, labels)
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    assert filter_audit.audit(docs, marks.limit(0)).agg(F.sum("good_lost")).head()[0] == 0


# --- decontamination ---------------------------------------------------------


def leak_words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected_leaks(docs, items, size):
    phrases = defaultdict(set)
    for item, text in items:
        words = leak_words(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            phrases[tuple(words[i : i + n])].add("" if item is None else str(item))
    lengths = {len(p) for p in phrases}
    found = []
    for doc_id, text in docs:
        words, hit, owners = leak_words(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (p := tuple(words[i : i + n])) in phrases:
                    hit |= set(range(i, i + n))
                    owners |= phrases[p]
        found.append((doc_id, len(words), len(hit), len(owners), H(",".join(sorted(owners))), bool(hit)))
    return Counter(found)


def leaking(seed):
    """Documents over few words, so that phrases overlap and repeat, and items of all lengths."""
    draw = random.Random(seed)
    items = [(i, sentence(draw, draw.choice([1, 2, 4, 9, 14]), "abc")) for i in range(30)]
    items += [(None, "Zulu ñandú"), (5, "another row"), (40, ""), (41, None), (42, "?!"), (43, "Zulu ñandú")]
    docs = odd_rows()
    for i in range(60):
        words = sentence(draw, draw.choice([3, 30, 200]), "abc").split()
        for _, text in draw.choices(items, k=3):
            at = draw.randrange(len(words))
            words[at:at] = (text or "").upper().split()
        docs.append((i, draw.choice([" ", "-- "]).join(words)))
    docs += [(70, "zulu, ÑANDÚ ñandú zulu ñandú"), (71, "zulu" * 3), (72, docs[-1][1])] + [(80 + i, docs[20][1]) for i in range(30)]
    return docs, items


@pytest.mark.parametrize(
    "size, block_bytes, shard_bytes",
    [(10, 8 << 20, 16 << 20), (10, 300, 16 << 20), (3, 8 << 20, 1), (3, 300, 16 << 20), (1, 8 << 20, 16 << 20)],
)
def test_leaks_equal_all_windows(spark, size, block_bytes, shard_bytes, monkeypatch):
    docs, items = leaking(size)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    benchmark = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, n_hit int")
    found = decontaminate.find_leaks(
        frame(spark, docs), benchmark, size, block_bytes=block_bytes, shard_bytes=shard_bytes
    ).collect()
    got = Counter((r.doc_id, r.n_words, r.n_hit, len(r["items"]), H(",".join(r["items"])), r.n_hit > 0) for r in found)
    assert got == expected_leaks(docs, items, size)
    for r in found:
        cut = [(r.text or "")[s.start : s.end] for s in r.spans]
        assert sum(len(leak_words(c)) for c in cut) == r.n_hit
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_leaks_of_empty_tables(spark):
    docs, items = leaking(1)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.digest(frame(spark, []), benchmark).count() == 0
    got = decontaminate.digest(frame(spark, docs), benchmark.limit(0))
    assert got.count() == len(docs) and got.filter("contaminated or n_items > 0").count() == 0


def test_leaks_are_cut_out(spark):
    benchmark = spark.createDataFrame([(1, "one two three"), (2, "three four")], "item_id long, text string")
    docs = frame(spark, [(1, "é A. One, two; THREE four? B one two three"), (2, "no one"), (3, None)])
    rows = {r.doc_id: r.text for r in decontaminate.remove_leaks(docs, benchmark, 3).select("doc_id", "text").collect()}
    assert rows == {1: "é A. ? B ", 2: "no one", 3: None}


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_all_places(seed):
    draw = random.Random(seed)
    runs = [[draw.randint(1, 3 + seed) for _ in range(draw.choice([1, 5, 40, 300]))] for _ in range(20)]
    runs += [[1] * 200, [1] * 150, [1, 2] * 60]
    symbols = np.array([s for run in runs for s in (*run, 0)])
    index = decontaminate.FMIndex(symbols, 12, rate=draw.choice([1, 4, 64]))
    for _ in range(60):
        n = draw.randint(1, 6)
        at = draw.randrange(len(symbols) - n)
        phrase = [int(s) for s in symbols[at : at + n] if s] or [9]
        low, high = index.search(np.array([[0] * (6 - len(phrase)) + phrase]))
        got = sorted(index.locate(np.arange(low[0], high[0])).tolist())
        text = symbols.tolist()
        assert got == [i for i in range(len(text)) if text[i : i + len(phrase)] == phrase]


def test_frames_have_clashing_columns(spark):
    assert {"n", "score", "words"} <= set(frame(spark, []).columns) and "n_chars" in SCHEMA
