"""Whitespace as Python's ``str.strip`` and ``re`` see it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character for which str.isspace() is true.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set inside a Java regex that carries the U flag.
SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Remove whitespace of any kind at both ends; linear in the text's length."""
    return F.btrim(text, F.lit(SPACE_CHARS))
