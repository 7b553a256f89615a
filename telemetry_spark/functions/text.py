"""Small text helpers shared by the scalar rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters trimming takes off, which are Unicode's separators and the line and tab controls.
SPACES = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chain(value: Column, *steps: Callable[[Column], Column]) -> Column:
    for step in steps:
        value = let(value, step)
    return value


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def is_blank(c: Column) -> Column:
    """True for null and for text made only of white space."""
    return F.coalesce(F.length(strip(c)), F.lit(0)) == 0


def blank_to_null(c: Column) -> Column:
    return F.when(~is_blank(c), c)


def empty_to_null(c: Column) -> Column:
    return F.when(F.length(c) > 0, c)


def replace_matches(c: Column, pattern: str, fn: Callable[[Column], Column]) -> Column:
    """Every match of ``pattern`` replaced by ``fn`` of its text: n matches leave n + 1 gaps to join them with."""
    gaps = F.split(c, pattern, -1)
    found = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), fn)
    pieces = F.zip_with(gaps, F.concat(found, F.array(F.lit(""))), lambda gap, text: F.concat(gap, text))
    return F.array_join(pieces, "")
