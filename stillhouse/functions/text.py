"""Column helpers with Python's text semantics, inside Spark's generated code.

Spark's ``trim`` only knows the blank and Java's ``\\s`` is ASCII; records here come from
Python programs, where ``strip``, ``split`` and ``splitlines`` use the Unicode sets below.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters for which Python's str.isspace() holds.
PY_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a pattern. Unicode properties are one lookup per character in Java, where a list
# of ranges is tried one by one.
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"
# Characters at which Python's str.splitlines() breaks (all of them are spaces too).
LINE_BREAK = r"[\n-\r\x1c-\x1e\x85\u2028-\u2029]"
# Spaces that do not break a line, with and without the plain blank.
INLINE_SPACE = r"[\p{Zs}\t\x1f]"
ODD_INLINE_SPACE = r"[\p{Zs}\t\x1f&&[^ ]]"


def strip(c: Column) -> Column:
    """``str.strip()``."""
    return F.btrim(c, F.lit(PY_SPACE))


def rstrip_chars(c: Column, chars: str) -> Column:
    """``str.rstrip(chars)``."""
    return F.rtrim(c, F.lit(chars))


def is_blank(c: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return c.isNull() | (strip(c) == "")


def collapse_space(c: Column, to: str = " ") -> Column:
    """``re.sub(r"\\s+", to, x)``."""
    return F.regexp_replace(c, SPACE + "+", to)


def normalised_lines(c: Column) -> Column:
    """Text with one ``\\n`` between lines: blank lines gone, each line stripped, inner
    whitespace collapsed, lower case. Two linear regex passes, no arrays.
    """
    one_blank = F.regexp_replace(c, f"{ODD_INLINE_SPACE}{INLINE_SPACE}*+|\\x20{INLINE_SPACE}++", " ")
    one_break = F.regexp_replace(one_blank, f"\\x20?{LINE_BREAK}{SPACE}*+", "\n")
    return F.lower(strip(one_break))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """``re.search`` then ``.group``: null, not '', where the pattern does not match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def unicode(pattern: str) -> str:
    """A caller's pattern with Python's reading of ``\\w``, ``\\d``, ``\\s`` and ``\\b``: by Unicode, not ASCII."""
    return "(?U)" + pattern


def dotall(pattern: str) -> str:
    """A caller's pattern with ``re.DOTALL``."""
    return "(?s)" + unicode(pattern)
