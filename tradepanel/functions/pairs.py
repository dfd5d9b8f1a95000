"""Expressions over unordered country pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradepanel.functions.scalars import col

# One quoted name, in single or double quotes.
_QUOTED = "'[^']*'|\"[^\"]*\""


def canonical_pair(a, b) -> Column:
    """Both names in sorted order, so (x, y) and (y, x) share a key."""
    return F.array(F.least(col(a), col(b)), F.greatest(col(a), col(b)))


def pair_text(pair) -> Column:
    """Array pair to "('A', 'B')"."""
    return F.concat(F.lit("('"), F.array_join(col(pair), "', '"), F.lit("')"))


def parse_pair(text) -> Column:
    """"('A', 'B')" to an array of the two names; names may hold an apostrophe."""
    quoted = F.regexp_extract_all(col(text), F.lit(_QUOTED), F.lit(0))
    return F.transform(quoted, lambda q: F.substring(q, F.lit(2), F.length(q) - 2))


def involves(a, b, home: str | int) -> Column:
    """The home country is on either side."""
    return (col(a) == home) | (col(b) == home)


def counterparty(a, b, home: str | int) -> Column:
    """The side that is not home."""
    return F.when(col(a) != home, col(a)).otherwise(col(b))
