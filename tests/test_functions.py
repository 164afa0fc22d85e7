"""Header fields and text cleaning against hand-made cases and plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tomewise.functions import header, text

CASES = [
    ("title", "Title: A B\r\nAuthor: X\r\n", "A B"),
    ("title", "title:   \n", ""),
    ("title", "Title:\n\nAuthor: X\n", "Author: X"),
    ("title", "Title: no newline", None),
    ("title", "Title:\xa0nb\n", "nb"),
    ("title", "Title: a\u2028b\n", "a\u2028b"),
    ("title", "Title: a\rb\n", "a\rb"),
    ("title", "Title:\x1c\nnext\n", "next"),
    ("title", "TITLE: one\nTitle: two\n", "one"),
    ("title", "x" * 1995 + "Title: far\n", None),
    ("title", "x" * 1980 + "Title: near\n", "near"),
    ("title", "\U0001f600" * 1980 + "Title: near\n", "near"),
    ("title", "", None),
    ("title", None, None),
    ("release_date", "Release Date: May 1, 1999 [EBook]\n", "May 1, 1999"),
    ("release_date", "Release Date: May 1\n", "May 1"),
    ("release_date", "Release Date: May 1\nLang: x\n\n", None),
    ("release_date", "Release Date: May 1\r\n\r\nx", "May 1"),
    ("release_date", "Release Date: May 1", "May 1"),
    ("release_year", "Release Date: May 1, 1999 [EBook]\n", 1999),
    ("release_year", "Release Date: 11999, 2004x, 2008\n", 2008),
    ("release_year", "Release Date: 1899 and 2100\n", None),
    ("release_year", "Release Date: unknown\n\n", None),
    ("language", "Language: English\r\n", "English"),
    ("encoding", "Character set encoding: UTF-8\n", "UTF-8"),
    ("author", "Author: A B [Ed] C\nq", "A BC"),
    ("author", "Author: Jane Doe [Translator]\r\n", "Jane Doe"),
    ("author", "Author: Bo\nx", None),
    ("author", "Author: Al [x]", None),
    ("author", "Author: Jane", "Jane"),
    ("author", "Author: Jane [Ed]", "Jane"),
    ("author", "no such field\n", None),
]


@pytest.mark.parametrize("field", sorted({field for field, _, _ in CASES}))
def test_fields(spark, field):
    cases = [(value, want) for name, value, want in CASES if name == field]
    rows = [(i, value) for i, (value, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r.id: r.x for r in df.select("id", getattr(header, field)(F.col("text")).alias("x")).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


# Texts made of known parts, so that what a field must be is known before the text is.
BLANKS = ["", " ", "\t ", "\xa0", "\u3000 ", "\x1c", "\n \n", "\u2028"]
VALUES = ["Mary", "Mary Ann", "1999", "May 1, 2004", "\U0001f600 x", "a\rb", "a\u2028b", "é" * 60, "12 x 34"]
NOISE = ["", "x\n", "\r\n\r\n", "no field here\n", "\U0001f600" * 90, "1999 [Ed]\n"]


def made(seed, n, part):
    draw = random.Random(seed)
    return [part(draw) for _ in range(n)]


def check(spark, column, cases):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "id int, text string")
    for row in df.select("id", column(F.col("text")).alias("x")).collect():
        assert row.x == cases[row.id][1], cases[row.id]


def test_titles_of_known_parts(spark):
    def part(draw):
        value, blank = draw.choice(VALUES), draw.choice(BLANKS)
        name, end = draw.choice(["Title:", "TITLE:", "title:"]), draw.choice(["\n", "\r\n", " \n", "\t\r\n"])
        return draw.choice(NOISE) + name + blank + value + end + draw.choice(NOISE), value

    check(spark, header.title, made(1, 600, part))


def test_dates_of_known_parts(spark):
    def part(draw):
        value, end = draw.choice(VALUES), draw.choice([" [EBook #1]\n", "[x", "\n\n", "\r\n\r\ny", "", "\n"])
        after = draw.choice(NOISE) if end not in ("", "\n") else ""
        return draw.choice(NOISE) + "Release Date:" + draw.choice(BLANKS) + value + end + after, value

    check(spark, header.release_date, made(2, 600, part))


def test_authors_of_known_parts(spark):
    def part(draw):
        first, last = draw.choice(["Mary", "Jo", "Élise B"]), draw.choice(["", "Ann", "of Ely"])
        note = draw.choice([" [Ed]", "[Translator] ", " [x y] "])
        line = draw.choice([f"{first} {last}", f"{first}{note}{last}", f"{first}{note}"])
        want = line.replace(note, "").strip()
        return draw.choice(NOISE) + "AUTHOR: " + line + "\r\n" + draw.choice(NOISE), want if len(want) > 2 else None

    check(spark, header.author, made(3, 600, part))


def test_bodies_of_known_parts(spark):
    def part(draw):
        k = draw.randrange(2)
        start, end = text.START_MARKERS[k], text.END_MARKERS[k]
        if draw.random() < 0.5:
            start, end = start.lower(), end.lower()
        body = draw.choice(["word", "a\n\nb", "\U0001f600 x", "", "*** x ***"])
        before = draw.choice(["", "head\n", "\U0001f600\n"])
        return f"{before}{start}{draw.choice(['', ' A ***'])}\n{draw.choice(BLANKS)}{body}\n{end} ***\n tail", body

    cases = made(4, 600, part)
    cases += [
        ("*** START OF THE PROJECT GUTENBERG EBOOK no newline", "*** START OF THE PROJECT GUTENBERG EBOOK no newline"),
        ("a *** END OF THE PROJECT GUTENBERG EBOOK\n*** START OF THE PROJECT GUTENBERG EBOOK\nb", ""),
        ("*** START OF THE PROJECT GUTENBERG EBOOK\nx\n*** START OF THIS PROJECT GUTENBERG EBOOK\ny", "y"),
        (" plain text\n", "plain text"),
    ]
    check(spark, text.strip_boilerplate, cases)


def one(spark, value, column):
    df = spark.createDataFrame([(value,)], "text string")
    return df.select(column(F.col("text")).alias("x")).head().x


def test_null_text(spark):
    assert one(spark, None, text.strip_boilerplate) == ""
    assert one(spark, None, text.words) == []


def test_normalize_keeps_edge_spaces(spark):
    assert one(spark, "  Été 12, A-b\x0b\n", text.normalize) == " t a b "


def test_words(spark):
    value = "The Cat's cat sat, and 3 naïve dogs RAN; ran up on the mat. déjà"
    assert one(spark, value, text.words) == ["cat", "cat", "sat", "dogs", "ran", "ran", "mat"]
    assert one(spark, "of it 12", text.words) == []
    assert len(set(text.STOP_WORDS)) == len(text.STOP_WORDS) == 70


def test_count_tokens_join_across_punctuation(spark):
    value = "We’re up-to DATE in 1999!\x0bv\t— x"
    assert one(spark, value, text.count_tokens) == ["were", "upto", "datein", "1999\x0bv", "x"]


def test_count_tokens_drop_every_other_character(spark):
    others = "\x85\u2028\u2029\xa0\x1c\u00e9\U0001f600_-\u0660"
    assert one(spark, f"a{others}b\r\fc", text.count_tokens) == ["ab", "c"]
