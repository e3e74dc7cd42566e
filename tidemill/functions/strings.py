"""Small string helpers shared by the other function modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The characters that count as white space when stripping (Spark's plain ``trim`` removes spaces only).
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times.

    Projections are merged by the optimizer, and expressions inside lambdas are not shared, so a costly
    value named twice would be computed twice; as a lambda argument it is computed once per row.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def prefix(c: Column, n: int | None) -> Column:
    """The first ``n`` characters (code points); None leaves all."""
    return c if n is None else F.substring(c, 1, n)


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, or null when there is no match or the group is empty."""
    return let(F.regexp_extract(c, pattern, group), null_if_empty)


def non_empty(parts: Column) -> Column:
    """Strip every element and drop the empty ones."""
    return F.filter(F.transform(parts, strip), lambda x: x != "")
