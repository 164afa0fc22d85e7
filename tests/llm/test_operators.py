"""The operators for training data against brute force, on small texts with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tomewise.llm import ann, bpe, jaccard, language, licenses, packing, pii, quality, toxicity, wrappers
from tomewise.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, score double, words int"


def sentence(draw, n, letters="abcdefghij"):
    return " ".join("".join(draw.choices(letters, k=draw.randint(2, 6))) for _ in range(n))


def frame(spark, rows, parts=3):
    """Documents of (doc_id, text[, lang]), with columns whose names operators use themselves."""
    full = [(*r, *(None,) * (3 - len(r)), "s", None, 7, 0.5, 1) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def odd_rows():
    """Null and empty texts, null ids, repeated rows, white space and special strings."""
    return [
        (1, None), (2, ""), (3, " \t\n\x0b"), (None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (5, "x"),
        (6, "Ünï ΣΑΣ 漢字 🙂\x1c\x85\xa0 end"), (7, "<|endoftext|> a<|endoftext|>b"), (8, "=" * 5000), (9, "w " * 4000),
    ]


# --- near copies -------------------------------------------------------------


def sets_of(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def expected_groups(rows, size, percent):
    found = [sets_of(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(found[i] & found[j])
            if found[i] and found[j] and 100 * both >= percent * len(found[i] | found[j]):
                root[top(i)] = top(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)].append(doc_id)
    ids = [min((x for x in least[top(i)] if x is not None), default=None) for i in range(len(rows))]
    return Counter((d, len(found[i]), ids[i] if found[i] else d) for i, (d, _) in enumerate(rows))


def near_copies():
    draw = random.Random(4)
    rows = odd_rows()
    shared = sentence(draw, 30).split()
    for group in range(14):
        base = sentence(draw, draw.choice([6, 12, 30, 60, 90, 200])).split()
        if group % 3 == 0:
            base[3:3] = shared
        for _ in range(draw.choice([1, 2, 5, 12])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
                copy[draw.randrange(len(copy))] = sentence(draw, 1)
            rows.append((len(rows) + 100, " ".join(copy).upper() if draw.random() < 0.2 else " ".join(copy)))
    return rows


@pytest.mark.parametrize(("frequent", "small", "crowd"), [(32, 64, 48), (2, 64, 2), (1, 1000, 3), (1, 4, 2)])
@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80)])
def test_groups_equal_all_pairs(spark, words, percent, frequent, small, crowd):
    rows = near_copies()
    got = jaccard.near_duplicates(
        frame(spark, rows), words=words, percent=percent, frequent=frequent, small_set=small, crowd=crowd
    )
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, got.collect())) == expected_groups(rows, words, percent)


def test_no_rows_no_groups(spark):
    assert jaccard.near_duplicates(frame(spark, [])).count() == 0


def test_signatures_of_similar_sets_meet():
    draw = np.random.default_rng(2)
    for _ in range(400):
        n = int(draw.integers(1, 120))
        x = np.unique(draw.integers(-(2**62), 2**62, n))
        gone = int(draw.integers(0, jaccard.spare(len(x), 85) + 1))
        y = np.unique(np.concatenate([draw.permutation(x)[gone:], draw.integers(-(2**62), 2**62, gone // 2)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 85 * (len(x) + len(y) - both):
            continue
        often = np.sort(draw.permutation(x)[: int(draw.integers(0, len(x) + 1))])
        # Some of the tokens that the other set lacks are known to be in no other.
        found = []
        for mine, other in ((x, y), (y, x)):
            alone = np.setdiff1d(mine[jaccard.counted(mine)], other)
            need = jaccard.spare(len(mine), 85) + 1 - len(alone)
            assert need > 0
            found.append(jaccard.signatures(mine, need, often, 85, 64))
        assert len(np.intersect1d(*found))
        p, q = jaccard.head(x, 85, 8), jaccard.head(y, 85, 8)
        need = min(len(p) - jaccard.spare(len(x), 85), len(q) - jaccard.spare(len(y), 85))
        assert len(np.intersect1d(p, q)) >= need


def test_common_tokens_of_blocks():
    draw = np.random.default_rng(5)
    for size in (1, 7, 40):
        blocks = []
        for _ in range(2):
            sets = [np.unique(draw.integers(0, draw.choice([20, 2000]), draw.integers(0, 60))) for _ in range(size)]
            blocks.append(sets)
        flat = [(np.array([len(s) for s in sets]), np.concatenate(sets)) for sets in blocks]
        want = [[len(np.intersect1d(a, b)) for b in blocks[1]] for a in blocks[0]]
        assert jaccard._common(*flat[0], *flat[1]).tolist() == want


def test_components_of_paths_and_stars(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (300, 301), (301, 300)]
    draw.shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    groups = defaultdict(set)
    for v, root in got.items():
        groups[root].add(v)
    assert sorted(map(len, groups.values())) == [2, 40, 61]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- tokens ------------------------------------------------------------------


def test_byte_bpe_equals_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    draw = random.Random(6)
    letters = "abcE \n\t\x1c\x85\xa0  '.,!?019éßİΣς漢🙂👍🏽'sll't#-_€"
    rows = odd_rows() + [(i, "".join(draw.choices(letters, k=draw.randint(0, 80)))) for i in range(100, 400)]
    rows += [(i, sentence(draw, 50)) for i in range(400, 420)]
    want = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back))))
    got = bpe.digest(frame(spark, rows), path, max_words=50)
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_lexicon_holds_its_words_only():
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["a", "ab", "abc", "bc", "c", "xabc", "éa", "tion", "nation"])}
    found = bpe.Lexicon.map(*bpe.Lexicon.compile(words).pack())
    asked = [*words, b"", b"b", b"abcd", b"xab", b"nat", b"zz"]
    assert found.find(asked) == [words.get(w) for w in asked]
    # Suffixes are shared: fewer arcs than letters behind a common beginning.
    assert len(found.arrays["final"]) < sum(map(len, words)) - 5
    assert bpe.Lexicon.map(*bpe.Lexicon.compile({}).pack()).find([b"a"]) == [None]


def test_long_words_merge_alike():
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for word in ("a" * 300, "abcab" * 90, "thethe" * 60):
        assert bpe.Merger(vocabulary)([word.encode()])[0] == tokenizer.encode(word).ids


def test_parts_of_the_lexicon_are_not_merged_again(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    vocabulary, merged, merge = bpe.Vocabulary.read(path), [], bpe.Merger.__call__
    lexicon = bpe.compile_lexicon(vocabulary, [" hovercraft"])
    monkeypatch.setattr(bpe.Merger, "__call__", lambda self, words: merged.extend(words) or merge(self, words))
    text = "My hovercraft. My hovercraft's full; hovercraft?!"
    assert bpe.encoder(vocabulary, lexicon)([text]) == [Tokenizer.from_file(path).encode(text).ids]
    assert b" hovercraft" not in merged and len(merged) == len(set(merged))


def test_frequent_words_are_counted_whole(spark):
    rows = [(1, " a b\u00a0a\n"), (2, None), (3, ""), (4, "c a\x1cb d"), (5, "c\u3000a ")]
    assert sorted(bpe.frequent_words(frame(spark, rows, 2), flush=1)) == [" a", " b", " c"]


# --- packing -----------------------------------------------------------------


def test_latin_words_pass_the_bare_model_only(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, seen = Tokenizer.from_file(path), []

    class Spy:
        def __getattr__(self, name):
            if name.startswith("encode"):
                return lambda texts, **kw: seen.append(texts) or getattr(tokenizer, name)(texts, **kw)
            return getattr(tokenizer, name)

    monkeypatch.setattr(packing, "_tokenizer", lambda path: Spy())
    encode = packing.word_encoder(path)

    def ids(texts):
        return [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]

    draw = random.Random(9)
    letters = "abcdEFÄéßŉñ   \n\t\u00a0.,;:!?'#$%019sll't\u00ad"
    latin = ["", " ", "\n a", "it's We'LL ''s a'", *("".join(draw.choices(letters, k=80)) for _ in range(300))]
    assert encode(latin) == ids(latin) and not seen
    odd = ["İstanbul Σας ΣΑΣ", "a\x1cb <|endoftext|>", "e\u0301 漢字 ǆ", "a b"]
    assert encode(odd) == ids(odd) and seen


def test_pieces_and_sequences(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    draw = random.Random(5)
    rows = odd_rows() + [(i, sentence(draw, draw.choice([1, 5, 30, 100, 900]))) for i in range(100, 200)]
    got = packing.pack(frame(spark, rows, 5), path).collect()
    want = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    # Best fit needs at most 1.7 times the least number; here the sum nearly decides.
    assert len(filled) <= -(-sum(w[3] for w in want) // 2048) * 1.05 + 1
    assert packing.pack(frame(spark, []), path).count() == 0


def test_sweep_is_best_fit():
    draw = random.Random(8)
    for _ in range(50):
        lengths = [draw.randint(1, 50) for _ in range(draw.randint(1, 200))]
        plan = packing.sweep(Counter(lengths), 50)
        gaps = []
        for length in sorted(lengths, reverse=True):
            fits = [g for g in gaps if g >= length]
            gap = min(fits) if fits else 50
            if fits:
                gaps.remove(gap)
            gaps.append(gap - length)
        assert len({first + i for _, _, n, first, _ in plan for i in range(n)}) == len(gaps)
        assert sum(n for _, _, n, _, _ in plan) == len(lengths)


# --- personal data -----------------------------------------------------------

PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def test_base_spans_equal_the_patterns():
    draw = random.Random(9)
    texts = ["".join(draw.choices("ab.@-+ 0123456789()%\n", k=draw.randint(0, 70))) for _ in range(20_000)]
    texts += ["4111 1111 1111 1111", "x 4111-1111-1111-1111.", "a@b@c.d.e a@b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1.5 0255.1.1.1"]
    for text in texts:
        want = []
        for kind, pattern in enumerate(PATTERNS):
            for m in pattern.finditer(text):
                digits = [int(c) for c in m[0] if c.isdigit()]
                doubled = sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
                fits = (
                    True,
                    kind == 1 and all(int(x) <= 255 for x in m[0].split(".")),
                    16 <= len(digits) <= 19 and doubled % 10 == 0,
                    8 <= len(digits) <= 15,
                )
                if fits[kind]:
                    want.append((kind, *m.span()))
        assert pii.base_spans(text) == want, text


def personal(draw, i):
    phone = f"+1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}"
    mail = f"{sentence(draw, 1)}{i}@mail.example.com"
    return f"{sentence(draw, 8)} call {phone} or {mail} in {draw.randint(1900, 2030)}. {sentence(draw, 5)}", phone


def test_field_adds_spans_and_keeps_the_base(spark):
    draw = random.Random(10)
    rows = odd_rows() + [(i, personal(draw, i)[0]) for i in range(100, 400)]
    docs = frame(spark, rows)
    model = pii.learn_field(docs)
    text, phone = personal(draw, 1)
    # The same number without its sign, far away from the first.
    text += " " + sentence(draw, 60) + f" call {phone[3:]} now, in {2001}."
    base = pii.base_spans(text)
    added = pii.added_spans(model, text, base, floor=0.6)
    assert all(text[a:b] in phone[3:] or text[a:b].strip("()") in phone for _, a, b in added)
    assert not pii.added_spans(pii.Field(), text, base)
    got = pii.digest(docs, model)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    values = dict(rows)
    for r in got.collect():
        mine = pii.base_spans(values[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.spell(mine).encode()).hexdigest()
        assert set(filter(None, pii.spell(mine).split(","))) <= set(r.spans.split(","))
    clean = pii.redact(docs, model=model)
    assert clean.columns == docs.columns
    assert clean.filter(F.col("text").rlike(r"[a-z0-9]@mail")).count() == 0
    assert pii.digest(frame(spark, []), pii.learn_field(frame(spark, []))).count() == 0


def test_messages_agree_with_all_labelings():
    draw = np.random.default_rng(3)
    model = pii.Field(6, draw.normal(size=(64, pii.LABELS)), draw.normal(size=(pii.LABELS,) * 2), draw.normal(size=(pii.LABELS,) * 2))
    # Two neighbours and no loop: message passing is exact.
    found = pii.tokens("x 12 345 y")
    p = pii.marginals(model, found, [pii.NONE] * 2, rounds=60)
    unary = [model.unary[pii._features(found, i, 6)].sum(0) for i in range(2)]
    joint = np.exp(unary[0][:, None] + unary[1][None] + model.chain)
    assert np.allclose(p[0], joint.sum(1) / joint.sum(), atol=1e-3)
    assert np.allclose(p[1], joint.sum(0) / joint.sum(), atol=1e-3)
    chain, skip = pii.edges(pii.tokens("5551234 a 555-1234 b 5551234 z c@d.e x c@d.e"))
    assert (chain, skip) == ([], [(0, 1), (0, 2), (3, 4)])


def test_a_label_reaches_the_fiftieth_repeat():
    """An observed label goes by way of the first like token to all of them, and to nothing else."""
    model = pii.Field(bits=13, unary=np.zeros((1 << 13, pii.LABELS)))
    model.skip = np.eye(pii.LABELS) * 3.0
    text = " . ".join(["5550123456 and 77"] * 50)
    found = pii.tokens(text)
    labels = [pii.NONE] * len(found)
    like = [i for i, t in enumerate(found) if "5550123456" in t.text]
    labels[like[20]] = 3
    p = pii.marginals(model, found, labels)
    assert len(like) == 50 and all(p[i].argmax() == 3 for i in like)
    assert p[like, 3].min() > 0.5
    assert np.allclose(p[[i for i in range(len(found)) if i not in like]], 1 / pii.LABELS)


def test_the_field_learns_from_whole_texts(spark):
    draw = random.Random(5)
    rows = [(i, sentence(draw, 300) + f" call +1 (555) 010-{1000 + i} now") for i in range(30)] + [(3, "+1 (555) 010-9999")] * 40
    field = pii.learn_field(frame(spark, rows))
    assert len(field.unary) and np.abs(field.unary[:, 3]).max() > 0
    # Nothing fits below the size of the smallest text.
    assert not len(pii.learn_field(frame(spark, rows[:30]), max_tokens=10).unary)


# --- quality and licenses ----------------------------------------------------


def test_quality_counts(spark):
    draw = random.Random(12)
    rows = [(*r, "en") for r in odd_rows()]
    for i in range(100, 200):
        words = sentence(draw, draw.choice([5, 25, 60]), "ab#").split()
        words += words[: draw.choice([0, 0, 9, 20])]
        rows.append((i, draw.choice([" ", "\n", " \n "]).join(words), draw.choice(["en", None])))
    want = Counter()
    for doc_id, text, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        n = Counter(windows)
        repeated = len({j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 8)})
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 20 or 100 * repeated > 30 * len(words)
        want[
            doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), repeated, failed,
        ] += 1
    got = quality.judge(frame(spark, rows)).collect()
    assert Counter(tuple(r)[:7] for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.judge(frame(spark, [])).count() == 0


def test_quality_distances(spark):
    draw = random.Random(13)
    words = ["the", "of", "and", "house", "tree", "to", "river", "in"]
    rows = [(i, " ".join(draw.choices(words, [8, 4, 4, 2, 2, 4, 2, 3], k=300)), "en") for i in range(40)]
    rows += [(90, " ".join(draw.choices(["#1", "$$9", "%42"], k=300)), "en"), (91, "SHORT " * 10 + sentence(draw, 20), "en")]
    got = {r.doc_id: r for r in quality.judge(frame(spark, rows)).collect()}
    total = Counter(w for _, t, _ in rows for w in t.split())
    n = sum(total.values())
    bins = [w for w in total if w in quality.COMMON_WORDS]

    def distance(counts):
        size = sum(counts.values())
        p = [counts[w] / size for w in bins]
        q = [total[w] / n for w in bins]
        p, q = np.array([*p, 1 - sum(p)]), np.array([*q, 1 - sum(q)])
        m = (p + q) / 2
        parts = [np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / m), 0).sum() for x in (p, q)]
        return float(np.sqrt(sum(parts) / 2))

    for doc_id in (0, 5, 90):
        text = next(t for i, t, _ in rows if i == doc_id)
        assert got[doc_id].word_distance == pytest.approx(distance(Counter(text.split())), abs=1e-9)
    assert got[91].word_distance is None and got[91].class_distance is None
    assert got[0].kept and not got[90].kept


def test_license_places(spark):
    draw = random.Random(14)
    parts = ["gnu", "general", "public", "license", "apache", "cc", "by", "MIT", "x9", "É", "Apache License", "mit license", "CC-BY"]
    rows = odd_rows() + [(i, draw.choice([" ", ", ", "\n"]).join(draw.choices(parts, k=draw.randint(0, 25)))) for i in range(100, 400)]
    want = Counter()
    for doc_id, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        starts, labels = [], set()
        for phrase, label in licenses.BASE:
            size = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(size)] == size]
            starts += at
            labels |= {label} if at else set()
        want[doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))] += 1
    got = licenses.scan(frame(spark, rows)).collect()
    assert Counter(tuple(r)[:6] for r in got) == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert licenses.scan(frame(spark, [])).count() == 0


def expected_labels(text, rules):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    joined = " " + " ".join(words) + " "
    found = []
    for rule in rules:
        if f" {rule.keyword} " in joined:
            for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", joined):
                found.append((m.start(), -m.end(), rule.priority, rule.label))
    found.sort()
    kept = {
        x[3]
        for i, x in enumerate(found)
        if not any(y[1] <= x[1] and y[2] <= x[2] for y in found[:i])
    }
    return kept | {label for phrase, label in licenses.BASE if f" {phrase} " in joined}


def test_license_rules(spark):
    assert len(licenses.rules()) > 200
    texts = [
        "Licensed under the Apache License, Version 2.0 (the License)", "SPDX-License-Identifier: GPL-3.0",
        "under the GNU Lesser General Public License v2.1", "Mozilla Public License 2.0 or the MIT License",
        "released under the terms of the BSD licence", "cc by-nc-sa 4.0", "the cat sat under the tree", "ISC license ISC license",
    ]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert set(filter(None, got[i].labels.split(","))) == expected_labels(text, licenses.rules()), text
    assert got[6].score == 0 and got[1].score == 1


def test_license_keywords_lose_nothing(spark):
    names = ["Attribution", "Attribution-NonCommercial-NoDerivs", "Attribution-NonCommercial-ShareAlike", "Attribution-NonCommercial"]
    names += ["Attribution-NoDerivatives", "Attribution Share Alike", "Zero"]
    texts = [f"{grant} the Creative Commons {n} {end}" for n in names for grant in ("Licensed under", "see") for end in ("4.0 License", "licence", "1.0")]
    texts += [f"{grant} the GNU {n} General Public License" for n in ("Library", "Lesser") for grant in ("distributed under", "see")]
    for label, _, name, short, versions in licenses.LICENSES:
        plain = re.sub(r"\(\?:[^()]*\)\?|\?", "", name).split("|")
        texts += [f"licensed under the {n} license {v}" for n in plain for v in ("", *versions)]
        texts += [f"SPDX-License-Identifier: {short or label} {v}" for v in ("", *versions)]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        joined = f" {' '.join(re.findall(r'[a-z0-9]+', text.lower()))} "
        found = []
        for rule in licenses.rules():
            found += [(m.start(), -m.end(), rule.priority, rule.label) for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", joined)]
        found.sort()
        kept = {x[3] for j, x in enumerate(found) if not any(y[1] <= x[1] and y[2] <= x[2] for y in found[:j])}
        kept |= {label for phrase, label in licenses.BASE if f" {phrase} " in joined}
        assert set(filter(None, got[i].labels.split(","))) == kept, text
    assert "cc-by" in got[0].labels and got[0].score > 0
    library = texts.index("see the GNU Library General Public License")
    assert "lgpl" in got[library].labels and got[library].score > 0


# --- language and toxicity ---------------------------------------------------

LANGUAGES = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}


def test_language_by_words_and_parts(spark):
    draw = random.Random(15)
    rows = [(i, sentence(draw, 30, LANGUAGES[x]).title(), x) for i, x in enumerate(draw.choices(list(LANGUAGES), k=200))]
    model = language.learn_languages(frame(spark, rows + [(900, None, "aa"), (901, "zz", None)]))
    assert model.languages == list(LANGUAGES)
    asked = [(i, sentence(draw, 12, LANGUAGES[x]), x) for i, x in enumerate(draw.choices(list(LANGUAGES), k=100))]
    asked += [(500, None, None), (501, "123 !?", None), (502, "漢字", None), (503, "", "aa")]
    got = {r.doc_id: r for r in language.add_language(frame(spark, asked), model).collect()}
    assert [got[i].lang_pred for i, _, _ in asked[:100]] == [x for _, _, x in asked[:100]]
    assert [got[i].lang_pred for i in (500, 501, 503)] == ["und"] * 3
    assert got[502].lang_pred == model.fallback
    assert all(0 <= r.score <= 1 for r in got.values())
    empty = language.learn_languages(frame(spark, []))
    assert language.add_language(frame(spark, asked), empty).filter("lang_pred != 'und'").count() == 0


def test_unseen_words_back_off(spark):
    model = language.LanguageModel(["x", "y"], "x", {"cat": 0}, {" d": 1, "og": 2}, np.array([[1, 5], [4, 2], [2, 6]], np.float32))
    identify = language.identify(model)
    # Of a new word the longest known parts count: both have two letters here.
    assert identify(["cat"])[0] == ["x"] and identify(["d"])[0] == ["y"] and identify(["dog"])[0] == ["x"]


def test_toxicity_of_held_out_texts(spark):
    draw = random.Random(16)
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        words = sentence(draw, 40).split()
        words.insert(3, "muslims" if draw.random() < (0.9 if bad else 0.1) else "people")
        if bad:
            words.insert(9, draw.choice(["blorgish", "blorgous", "zonk"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    labels += [(5, 0), (None, 1), (7, None)]
    docs, marks = frame(spark, rows + [(900, None), (901, "")]), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn_toxicity(docs, marks, learn=F.col("doc_id") < 400)
    got = {r.doc_id: r.toxic_score for r in toxicity.add_toxicity(docs, model, score="toxic_score").collect()}
    right = [(got[i] >= 0.5) == (i % 5 == 0) for i in range(400, 600)]
    assert sum(right) >= 195
    assert got[900] == got[901] < 0.5
    # The group's name stands near insults, and yet does not weigh more than another group's.
    loose = toxicity.learn_toxicity(docs, marks, learn=F.col("doc_id") < 400, counterfactual_weight=0.0)
    text = "some muslims went home"
    swapped = text.replace("muslims", toxicity.SWAP["muslims"])

    def gap(m):
        a, b = toxicity.scorer(m)([text, swapped])[0]
        return abs(np.log(a / (1 - a)) - np.log(b / (1 - b)))

    assert gap(model) < 0.3 * gap(loose) and toxicity.scorer(model)([text])[0][0] < 0.5
    nothing = toxicity.learn_toxicity(frame(spark, []), marks)
    assert toxicity.scorer(nothing)(["a", None])[0] == pytest.approx([0, 0], abs=1e-9)


# --- pages and vectors -------------------------------------------------------


def page(draw, menu=True):
    """A page made of known blocks, and its main text."""
    blocks = [sentence(draw, draw.randint(3, 20)) for _ in range(draw.randint(1, 6))]
    body = "".join(f"<p>{b[:5]}<b>{b[5:]}</b>{'</p>' if draw.random() < 0.7 else ''}" for b in blocks)
    side = f"<ul>{''.join(f'<li><a href=/{i}>{sentence(draw, 1)}</a>' for i in range(draw.randint(1, 5)))}</ul>"
    note = '<div class="notice box">Accept &amp; go</div>' if draw.random() < 0.5 else ""
    comments = f'<section id="comments"><p>{sentence(draw, 9)}</p></section>' if draw.random() < 0.5 else ""
    text = (
        f"<html><head><title>{sentence(draw, 3)}</title><script>var x='</p><p>';</script></head><body>"
        f"{f'<nav>{side}</nav>' if menu else ''}{note}<!-- {sentence(draw, 2)} --><article><h1>T &eacute;</h1>{body}"
        f'<div class="ad-box">{sentence(draw, 4)}</div><form><input><button>Go</button></form></article>{comments}'
        f"<footer>&copy; {sentence(draw, 2)}</footer>"
    )
    return text, " ".join(["T é", *(" ".join(b.split()) for b in blocks)])


def test_main_text_of_known_blocks(spark):
    draw = random.Random(17)
    made = [page(draw, i % 2 == 0) for i in range(60)]
    rows = [(i, f"http://{'hot' if i % 3 else 'h' + str(i)}.example/{i}", h, "old") for i, (h, _) in enumerate(made)]
    rows += [(90, None, None, None), (91, "http://hot.example/x", "", None), (92, None, "<p>plain <b>text</b>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(5)
    got = {r.page_id: r.text for r in wrappers.main_text(df, wrappers.learn_wrappers(df)).collect()}
    # The heading is the same on every page of a host and so is part of its template where pages are many.
    for i, (_, text) in enumerate(made):
        assert got[i] in (text, text.removeprefix("T é ")), i
    assert got[90] == got[91] == "" and got[92] == "plain text"
    none = df.limit(0)
    assert wrappers.main_text(none, wrappers.learn_wrappers(none)).count() == 0


def test_deep_and_broken_pages(spark):
    """Nested elements keep their text in order, menus in them stay out, and no tag is searched for twice."""
    deep = "<article>" + "".join(f"<div>t{i} " for i in range(5000)) + "</div>" * 5000 + " end</article>"
    inner = "<main>" + "<div>" * 300 + "a<p>b</p>c<nav>no<div>no</div></nav>d" + "</div>" * 300 + "e</main>"
    pages = [(1, deep), (2, inner), (3, "<p>x</p>" + "<a '" * 20_000), (4, "<p>x</p> y <!-- a <b> c"), (5, "x <!-- <"), (6, "<" * 9000)]
    df = spark.createDataFrame([(i, f"http://h{i}.org/", p) for i, p in pages], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.main_text(df, wrappers.learn_wrappers(df)).collect()}
    assert got[1] == " ".join(f"t{i}" for i in range(5000)) + " end"
    assert got[2] == "a b c d e" and got[4] == "x y" and got[5] == "x" and got[6] == "<" * 9000
    assert got[3].startswith("x <a '<a '")


def test_wrappers_generalize():
    a, b = (wrappers._of(wrappers.parse(f"<article><h1>{x}</h1><p>{x}{y}</article>")) for x, y in (("u", ""), ("v", "<p>w<ul><li>z</ul>")))
    merged = wrappers.merge(a, b)["k"][0]
    assert [(x["l"], x["r"], x["o"], x["t"]) for x in merged["k"]] == [("h1", 0, 0, None), ("p", 1, 0, None), ("ul", 0, 1, "")]


def test_layouts_and_copies_of_a_host(spark):
    draw = random.Random(19)
    menu = '<div class="nav"><a href=/>home</a></div>'
    rows, want = [], {}

    def add(host, body, text):
        rows.append((len(rows), f"http://{host}.example/{len(rows)}", f"<body>{menu}{body}<footer>end</footer></body>"))
        want[len(rows) - 1] = text

    def article(texts):
        return "<article>" + "".join(f"<{t}>{x}</{t}>" for t, x in texts) + "</article>"

    for i in range(20):
        a, b = sentence(draw, 9), sentence(draw, 7)
        # Pages with an article and pages with plain text on one host.
        add("mixed", article([("p", a)]) if i % 2 else f"<div><p>{a}</p><p>{b}</p></div>", a if i % 2 else f"{a} {b}")
        # The same subheadings in all articles.
        add("same", article([("h2", "Facts"), ("p", a), ("h2", "More"), ("p", b)]), f"Facts {a} More {b}")
    # Copies of one page, with and without an article, four or ten.
    for n in (4, 10):
        for _ in range(n):
            add(f"copies{n}", article([("h1", "Title"), ("p", "one two"), ("h2", "Part"), ("p", "three")]), "Title one two Part three")
            add(f"plain{n}", "<div><p>four five six</p></div>", "four five six")
    # What many different pages share outside of articles is part of the template.
    for _ in range(10):
        a = sentence(draw, 8)
        add("template", f"<h4>all rights</h4><p>{a}</p>", a)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in wrappers.main_text(df, wrappers.learn_wrappers(df)).collect()}
    assert got == want


def test_recall_with_many_lists(spark):
    draw = np.random.default_rng(20)
    vectors = draw.normal(size=(8000, 32)).astype("float32")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(4)
    found = defaultdict(set)
    for r in ann.nearest(df, F.col("vec_id") % 100 == 0, list_size=16).collect():
        found[r.query_id].add(r.vec_id)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = sum(len(got & set(np.argsort(-(unit @ unit[q]))[1:6].tolist())) for q, got in found.items())
    assert len(found) == 80 and hits >= 0.98 * 5 * len(found)


def test_neighbours_and_recall(spark):
    draw = np.random.default_rng(18)
    vectors = draw.normal(size=(3000, 16)).astype("float32")
    vectors[100:1100] = vectors[100]
    vectors[1200] = vectors[1201] * 2
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    rows += [(5000, None, 1), (5001, [0.0] * 16, 1), (5002, [float("nan")] * 16, 1), (5003, [1.0, None] * 8, 1), (None, [1.0] * 16, 1)]
    rows += [(2999, vectors[2999].tolist(), 1), (5050, [1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").repartition(4)
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert sorted(got) == list(range(0, 3000, 50))
    unit = vectors.astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    hits = 0
    for q, found in got.items():
        scores = unit @ unit[q]
        scores[q] = -9
        want = np.lexsort((np.arange(3000), -np.round(scores, 12)))[:5]
        hits += len({v for v, _ in found} & set(want.tolist()))
        assert len(found) == 5
        for v, s in found:
            assert s == pytest.approx(scores[v], abs=1e-9)
    assert hits >= 0.9 * 5 * len(got)
    assert [v for v, _ in got[150]] == [100, 101, 102, 103, 104]
    few = ann.nearest(df.filter("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert [r.rank for r in few] == [1, 2]
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_walk_meets_what_a_full_product_finds():
    draw = np.random.default_rng(21)
    centers = draw.normal(size=(12, 24))
    points = ann._unit(np.repeat(centers, 200, 0) + 0.4 * draw.normal(size=(2400, 24)))
    centroids = ann.fit_centroids(points, 150)
    links = ann.graph(centroids)
    queries = points[::40]
    away = ann.distances(queries, centroids)
    full = np.ones(len(centroids), bool)
    for ratio in (1.0, 1.2, 1.5):
        want = away <= ratio * away.min(1, keepdims=True)
        got = ann.lists_to_read(centroids, links, queries, ratio, 0.0, full)
        hits = sum(want[i, c] for i, row in enumerate(got) for c in row)
        assert hits >= 0.98 * want.sum() and all(got)
    everything = ann.lists_to_read(centroids, links, queries, float("inf"), 0.0, full)
    assert all(sorted(row) == list(range(len(centroids))) for row in everything)
    # Where only one list is full, each query reads up to it; where none is, all lists.
    full[:] = False
    assert all(len(row) == len(centroids) for row in ann.lists_to_read(centroids, links, queries, 1.0, 0.0, full))
    full[7] = True
    assert all(7 in row for row in ann.lists_to_read(centroids, links, queries, 1.0, 0.0, full))
