"""License scans: ordered signature rules on normalized words, gated by keywords.

A rule has a priority, a label, a keyword and a pattern. Only texts that hold the keyword are searched for the pattern,
which can not match without it.
A detection that lies within another one of the same or a better priority is suppressed; of two that cover the same
words the better, then the first label stays. What is left, and the four base phrases, are the labels.

Texts are lower-cased and their words joined by single blanks, so that patterns are written on words. Everything is a
DataFrame expression in the row of the text. Null text is empty: no words, no labels, score 0. Repeated rows are
scanned alike; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases with their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Label, keyword that is a word of the name, name, words of the identifier without the version, versions.
# A license whose names have no word in common has a row for each name; only one of them has the identifier.
LICENSES = (
    ("agpl", "affero", "gnu affero general public", "agpl", ("3 0", "1 0")),
    ("lgpl", "lesser", "gnu lesser general public", "lgpl", ("3 0", "2 1", "2 0")),
    ("lgpl", "library", "gnu library general public", None, ("3 0", "2 1", "2 0")),
    ("gpl", "general", "gnu general public", "gpl", ("3 0", "2 0", "1 0")),
    ("gfdl", "documentation", "gnu free documentation", "gfdl", ("1 3", "1 2", "1 1")),
    ("apache", "apache", "apache(?: software)?", "apache", ("2 0", "1 1", "1 0")),
    ("mit", "mit", "mit", "mit", ("0",)),
    ("bsd", "bsd", "(?:(?:new|modified|simplified|2 clause|3 clause|4 clause) )?bsd", "bsd", ("2 clause", "3 clause", "4 clause")),
    ("isc", "isc", "isc", "isc", ()),
    ("mpl", "mozilla", "mozilla public", "mpl", ("2 0", "1 1", "1 0")),
    ("epl", "eclipse", "eclipse public", "epl", ("2 0", "1 0")),
    ("edl", "eclipse", "eclipse distribution", "edl", ("1 0",)),
    ("cddl", "distribution", "common development and distribution", "cddl", ("1 1", "1 0")),
    ("cpl", "common", "common public", "cpl", ("1 0",)),
    ("eupl", "european", "european union public", "eupl", ("1 2", "1 1", "1 0")),
    ("artistic", "artistic", "artistic", "artistic", ("2 0", "1 0")),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib", ()),
    ("boost", "boost", "boost software", "bsl", ("1 0",)),
    ("unlicense", "unlicense", "the unlicense|unlicense", "unlicense", ()),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl", ("2",)),
    ("cc0", "cc0", "cc0", "cc0", ("1 0",)),
    ("cc0", "creative", "creative commons zero", None, ("1 0",)),
    ("cc-by-nc-nd", "creative", "creative commons attribution noncommercial no ?deriv(?:ative)?s", "cc by nc nd", ("4 0", "3 0", "2 5", "2 0")),
    ("cc-by-nc-sa", "creative", "creative commons attribution noncommercial share ?alike", "cc by nc sa", ("4 0", "3 0", "2 5", "2 0")),
    ("cc-by-nc", "creative", "creative commons attribution noncommercial", "cc by nc", ("4 0", "3 0", "2 5", "2 0")),
    ("cc-by-nd", "creative", "creative commons attribution no ?deriv(?:ative)?s", "cc by nd", ("4 0", "3 0", "2 5", "2 0")),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike", "cc by sa", ("4 0", "3 0", "2 5", "2 0")),
    ("cc-by", "creative", "creative commons attribution", "cc by", ("4 0", "3 0", "2 5", "2 0")),
    ("ofl", "font", "sil open font|open font", "ofl", ("1 1", "1 0")),
    ("psf", "python", "python software foundation", "psf", ("2 0",)),
    ("php", "php", "php", "php", ("3 01", "3 0")),
    ("ruby", "ruby", "ruby", "ruby", ()),
    ("openssl", "openssl", "openssl", "openssl", ()),
    ("postgresql", "postgresql", "postgresql", "postgresql", ()),
    ("ms-pl", "microsoft", "microsoft public", "ms pl", ()),
    ("ms-rl", "microsoft", "microsoft reciprocal", "ms rl", ()),
    ("odbl", "database", "open database", "odbl", ("1 0",)),
    ("pddl", "public", "public domain dedication and", "pddl", ("1 0",)),
    ("osl", "open", "open software", "osl", ("3 0", "2 1")),
    ("afl", "academic", "academic free", "afl", ("3 0", "2 1")),
    ("ncsa", "illinois", "(?:university of )?illinois(?: ncsa)? open source", "ncsa", ()),
    ("vim", "vim", "vim", "vim", ()),
)


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    keyword: str
    pattern: str


# Forms of a signature in order of priority, with the score of a text whose best detection has it.
SCORES = (1.0, 0.95, 0.9, 0.8)
BASE_SCORE = 0.7





def rules() -> list[Rule]:
    """The signatures of every license: its identifier, a grant, its name with a version, and its name alone."""
    found = []
    word = "licen[cs]e"
    for label, keyword, name, short, versions in LICENSES:
        name = f"(?:{name})"
        if short is not None:
            first = short.split()[0]
            found.append(Rule(1, label, first, f"spdx {word} identifier {short}(?: [0-9]+)*"))
            found.append(Rule(1, label, first, f"licen[cs]es {short}(?: [0-9]+)*"))
        found.append(Rule(2, label, keyword, f"licen[cs]ed under (?:the |an? )?{name}(?: {word})?(?: (?:version|v))?(?: [0-9]+)*"))
        found.append(Rule(2, label, keyword, f"(?:released|distributed|available|published) under (?:the |an? )?(?:terms of the )?{name}(?: {word})?"))
        found.append(Rule(4, label, keyword, f"{name} {word}"))
        for version in versions:
            found.append(Rule(3, f"{label}-{version.replace(' ', '.')}", keyword, f"{name}(?: {word})?(?: (?:version|v))? {version}"))
            if short is not None:
                found.append(Rule(3, f"{label}-{version.replace(' ', '.')}", first, f"{short}(?: v)? {version}"))
    return found


def _words(text: Column) -> Column:
    """Blanks in a text that has one before each word and one at the end, less one: its words."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) - 1


def _spans(text: Column, rule: Column) -> Column:
    """Detections of a rule: start, negative end, priority, label; places count characters."""
    bounded = F.concat(F.lit("(?<= )(?:"), rule["pattern"], F.lit(")(?= )"))
    parts = F.struct(F.split(text, bounded, -1).alias("between"), F.regexp_extract_all(text, bounded, F.lit(0)).alias("matched"))
    kind = "array<struct<start:int,neg_end:int,priority:int,label:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))

    def place(both: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            begin = acc["at"] + F.length(F.get(both["between"], i))
            end = begin + F.length(F.get(both["matched"], i))
            one = F.struct(
                begin.alias("start"), (-end).alias("neg_end"), rule["priority"].alias("priority"), rule["label"].alias("label")
            )
            return F.struct(end.alias("at"), F.concat(acc["found"], F.array(one)).alias("found"))

        places = F.filter(F.sequence(F.lit(0), F.size(both["matched"])), lambda i: i < F.size(both["matched"]))
        return F.aggregate(places, start, step, lambda acc: acc["found"])

    # An array of one element gives the parts a name, so that they are made once.
    return F.flatten(F.transform(F.array(parts), place))


def _surviving(detections: Column) -> Column:
    """Labels and priorities of detections that no other one of the same or a better priority contains.

    In order of start and descending end, whatever contains a detection comes before it; so the farthest end of each
    priority seen so far decides.
    """
    levels = len(SCORES)
    kind = "array<struct<label:string,priority:int>>"
    start = F.struct(
        F.array_repeat(F.lit(-1), levels).alias("ends"),
        F.array().cast(kind).alias("kept"),
    )

    def step(acc: Column, x: Column) -> Column:
        inside = F.get(acc["ends"], x["priority"] - 1) >= -x["neg_end"]
        ends = F.transform(
            acc["ends"], lambda e, i: F.when(i + 1 >= x["priority"], F.greatest(e, -x["neg_end"])).otherwise(e)
        )
        one = F.array(F.struct(x["label"].alias("label"), x["priority"].alias("priority")))
        kept = F.when(inside, acc["kept"]).otherwise(F.array_union(acc["kept"], one))
        return F.struct(ends.alias("ends"), kept.alias("kept"))

    return F.aggregate(F.array_sort(detections), start, step, lambda acc: acc["kept"])


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", signatures: list[Rule] | None = None) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    signatures = rules() if signatures is None else signatures
    value = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    joined = F.trim(F.regexp_replace(value, SEPARATORS, " "))
    step = df.select(
        F.col(doc_id).alias("doc_id"),
        F.when(joined == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), joined, F.lit(" "))).alias("t"),
    ).withColumn("n", _words(F.col("t")))

    t, n = F.col("t"), F.col("n")
    places, kind = [], "struct<n:int,first:int,last:int,label:string>"
    for phrase, label in BASE:
        parts = F.split(t, f"(?<= ){phrase}(?= )", -1)
        size = len(phrase.split())
        one = F.struct(
            (F.size(parts) - 1).alias("n"),
            _words(F.element_at(parts, 1)).alias("first"),
            (n - size - _words(F.element_at(parts, -1))).alias("last"),
            F.lit(label).alias("label"),
        )
        places.append(F.when(F.contains(t, F.lit(f" {phrase} ")), one).otherwise(F.lit(None).cast(kind)))
    step = step.withColumn("base", F.filter(F.array(*places), lambda x: x.isNotNull()))

    table = F.array(
        *(
            F.struct(
                F.lit(r.priority).alias("priority"),
                F.lit(r.label).alias("label"),
                F.lit(f" {r.keyword} ").alias("keyword"),
                F.lit(r.pattern).alias("pattern"),
            )
            for r in signatures
        )
    )
    # Every match of a pattern has its keyword in it as a word, so the gates lose none.
    words = sorted({r.keyword for r in signatures})
    gate = t.rlike(" (?:licen[cs]e[ds]?|under|" + "|".join(words) + ") ")
    open_rules = F.filter(table, lambda r: F.contains(t, r["keyword"]))
    kind = "array<struct<start:int,neg_end:int,priority:int,label:string>>"
    found = F.when(gate, F.flatten(F.transform(open_rules, lambda r: _spans(t, r)))).otherwise(F.array().cast(kind))
    step = step.select("doc_id", "n", "base", found.alias("found")).withColumn("kept", _surviving(F.col("found")))

    base = F.col("base")
    labels = F.array_union(F.transform(base, lambda x: x["label"]), F.transform("kept", lambda x: x["label"]))
    best = F.array_min(F.transform("kept", lambda x: x["priority"]))
    score = F.when(best.isNotNull(), F.get(F.array(*map(F.lit, SCORES)), best - 1))
    return step.select(
        F.col("doc_id").alias(doc_id),
        F.col("n").cast("long").alias("n_words"),
        F.aggregate(base, F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["last"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda x: x["label"]))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.coalesce(score, F.when(F.size(base) > 0, F.lit(BASE_SCORE)), F.lit(0.0)).alias("score"),
    )
