from __future__ import annotations

from tomewise.operators.wordcount import word_count

LINES = [
    "We’re up all night till the sun",
    "We’re up all night to get some",
    "We’re up all night for good fun",
    "We’re up all night to get lucky",
]
COUNTS = {"all": 4, "night": 4, "up": 4, "were": 4, "get": 2, "to": 2}
COUNTS |= dict.fromkeys("for fun good lucky some sun the till".split(), 1)


def test_golden(spark):
    df = spark.createDataFrame([(line,) for line in LINES], "value string")
    got = {r["word"]: r["count"] for r in word_count(df).collect()}
    assert got == COUNTS
    assert sum(got.values()) == 28


def test_empty_lines_have_no_words(spark):
    df = spark.createDataFrame([("",), ("  ",), ("’!",), (None,)], "value string")
    assert word_count(df).count() == 0
