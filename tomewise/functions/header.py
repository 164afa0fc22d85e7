"""Fields of a book's header, as native expressions.

Only the first 2000 characters are searched, case is ignored, the first match
counts, and a field that is not there is NULL. The flags make Java's regex agree
with Python's: ``i`` and ``U`` ignore case and know whitespace, digits and word
edges of all of Unicode, ``d`` lets only ``\\n`` end a line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tomewise.functions.whitespace import SPACE, strip

HEADER_CHARS = 2000
FLAGS = "(?idU)"

# How each field is written in a header.
TITLE = rf"Title:{SPACE}*(.+?)(?:\r?\n)"
RELEASE_DATE = rf"Release Date:{SPACE}*(.+?)(?:\[|$|\r?\n\r?\n)"
LANGUAGE = rf"Language:{SPACE}*(.+?)(?:\r?\n)"
ENCODING = rf"Character set encoding:{SPACE}*(.+?)(?:\r?\n)"
YEAR = r"\b(19\d{2}|20\d{2})\b"
AUTHOR_LINE = rf"Author:{SPACE}*(.+?)(?:\r?\n)"
AUTHOR_TO_BRACKET = rf"Author:{SPACE}*(.+?)(?:\[|$)"
BRACKETED = rf"{SPACE}*\[.*?\]{SPACE}*"


def _first(text: Column, pattern: str) -> Column:
    # Every pattern's group takes at least one character, so '' means no match.
    return F.nullif(F.regexp_extract(text, FLAGS + pattern, 1), F.lit(""))


def header(text: Column) -> Column:
    return F.substring(text, 1, HEADER_CHARS)


def title(text: Column) -> Column:
    return strip(_first(header(text), TITLE))


def release_date(text: Column) -> Column:
    return strip(_first(header(text), RELEASE_DATE))


def language(text: Column) -> Column:
    return strip(_first(header(text), LANGUAGE))


def encoding(text: Column) -> Column:
    return strip(_first(header(text), ENCODING))


def year(date: Column) -> Column:
    """First four-digit year from 1900 to 2099 in a date string, as INT."""
    return _first(date, YEAR).try_cast("int")


def release_year(text: Column) -> Column:
    return year(_first(header(text), RELEASE_DATE))


def author(text: Column) -> Column:
    """Author without bracketed remarks; names of one or two letters are refused."""

    def named(pattern: str) -> Column:
        found = strip(_first(header(text), pattern))
        name = strip(F.regexp_replace(found, FLAGS + BRACKETED, ""))
        return F.when(F.length(name) > 2, name)

    return F.coalesce(named(AUTHOR_LINE), named(AUTHOR_TO_BRACKET))
