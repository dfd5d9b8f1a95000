"""Scalar expressions with explicit null, floor and rounding rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_LOW = 1048576.0  # 2 ** 20


# Windows of 24 bits, by the unit of each; a term below _MOST is cut into one whole number for each window.
_WINDOWS = [2.0**24, 1.0, 2.0**-24, 2.0**-48, 2.0**-72]
_MOST = 2.0**53


def _window_sum(value: Column) -> Column:
    """Exact sum of doubles of any scale: adding and taking away 1.5 * 2**52 units leaves the part of a term that is whole in them.

    The parts are summed as longs, which 2**34 rows of the largest terms cannot overflow. Terms from 2**53, NaN, infinities, and what lies below
    the last window, which only terms under 5e-7 have, are summed as plain doubles.
    """
    plain = F.isnan(value) | (F.abs(value) >= F.lit(_MOST))
    rest = F.when(plain, F.lit(0.0)).otherwise(value)
    sums = []
    for unit in _WINDOWS:
        magic = F.lit(1.5 * 2.0**52 * unit)
        part = (rest + magic) - magic
        sums.append(F.sum((part / F.lit(unit)).cast("bigint")).cast("double") * F.lit(unit))
        rest = rest - part
    total = F.sum(F.when(plain, value).otherwise(rest))
    for part in reversed(sums):
        total = part + total
    return total


def exact_sum(c: Column | str, digits: int | None = 4) -> Column:
    """Sum that does not depend on the order of its terms, as a double.

    ``digits`` is the number of decimals that the terms are known to have; None takes terms of any scale as they are. Otherwise
    each term is rounded to ``digits`` decimals, taken as a whole number of such units and split
    at 2**20 into two longs. Long sums are exact and stay in generated code, which makes this several
    times cheaper than a decimal sum; the split keeps totals far beyond one long safe. NaN,
    infinities and terms beyond 2**60 units are added as plain doubles.
    """
    value = col(c).cast("double")
    if digits is None:
        return _window_sum(value)
    scaled = value * F.lit(10.0**digits)
    plain = F.isnan(value) | (F.abs(scaled) > F.lit(2.0**60))
    units = F.when(plain, F.lit(0.0)).otherwise(F.rint(scaled))
    high = F.floor(units / F.lit(_LOW))
    low = (units - high * F.lit(_LOW)).cast("bigint")
    total = F.sum(high).cast("double") * F.lit(_LOW) + F.sum(low).cast("double")
    return total / F.lit(10.0**digits) + F.coalesce(F.sum(F.when(plain, value)), F.lit(0.0))


def mean_of(c: Column | str, digits: int | None = 9) -> Column:
    """Exact sum over the non-null count; a group without values gives null."""
    return F.try_divide(exact_sum(c, digits), F.count(col(c)))


def zero_sum(c: Column | str) -> Column:
    """Group sum in which an all-null group counts as 0."""
    return F.coalesce(F.sum(col(c)).cast("double"), F.lit(0.0))


def log_floor(c: Column | str, floor: float = 1.0) -> Column:
    """Natural log of the value raised to ``floor``; null stays null."""
    return F.when(col(c).isNotNull(), F.ln(F.greatest(col(c), F.lit(floor))))


def log1p(c: Column | str) -> Column:
    return F.log1p(col(c))


def log10(c: Column | str) -> Column:
    return F.log10(col(c))


def clip(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value on either side; null stays null."""
    bounded = col(c)
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(col(c).isNotNull(), bounded)


def round_even(c: Column | str, digits: int = 2) -> Column:
    """Round half to even."""
    return F.bround(col(c), digits)


def to_number(c: Column | str, kind: str = "double") -> Column:
    """Numeric cast in which bad text becomes null."""
    return col(c).try_cast(kind)


def add_strict(a: Column | str, b: Column | str) -> Column:
    """Null as soon as one side is missing."""
    return col(a) + col(b)


def add_zero_fill(a: Column | str, b: Column | str) -> Column:
    """A missing side counts as 0."""
    return F.coalesce(col(a), F.lit(0.0)) + F.coalesce(col(b), F.lit(0.0))


def differs(c: Column | str, value) -> Column:
    """Not equal, with null counted as different."""
    return ~col(c).eqNullSafe(F.lit(value))


def ratio(a: Column | str, b: Column | str) -> Column:
    """Quotient; a zero or missing divisor gives null."""
    return F.try_divide(col(a), col(b))


def percent_change(new: Column | str, old: Column | str) -> Column:
    """(new - old) / old * 100."""
    return F.try_divide(col(new) - col(old), col(old)) * F.lit(100.0)


def code_section(c: Column | str) -> Column:
    """Two-character, zero-padded section of a commodity code; missing gives '00'.

    Float text such as '9.0' is read as the number 9 first.
    """
    whole = col(c).try_cast("double").cast("int").cast("string")
    return F.coalesce(F.lpad(whole, 2, "0"), F.lit("00"))


def month_of_text(c: Column | str) -> Column:
    """'2013 Jan' (blank-padded or not) as a timestamp; bad text gives null."""
    return F.try_to_timestamp(F.trim(col(c)), F.lit("yyyy MMM"))


def clean_text(c: Column | str, replacements: dict[str, str] | None = None) -> Column:
    """Trim, then replace each listed piece of text."""
    cleaned = F.trim(col(c))
    for old, new in (replacements or {}).items():
        cleaned = F.replace(cleaned, F.lit(old), F.lit(new))
    return cleaned


def rate_text(rate, currency, entity, year, home_currency: str) -> Column:
    """'<rate> <currency> per <home currency>', or the not-available sentence."""
    missing = F.concat(
        F.lit("Exchange rate data not available for "), col(entity), F.lit(" in "), col(year).cast("string")
    )
    present = F.concat(
        F.format_number(col(rate), 2), F.lit(" "), col(currency), F.lit(f" per {home_currency}")
    )
    return F.coalesce(present, missing)


def billions_text(value) -> Column:
    """'12.34B', grouped by thousands."""
    return F.concat(F.format_number(col(value) / F.lit(1e9), 2), F.lit("B"))


def output_text(home: str, home_value, entity, value, year) -> Column:
    """Two-line comparison of national outputs, or the not-available sentence."""
    when = col(year).cast("string")
    present = F.concat(
        F.lit(f"{home} GDP in "), when, F.lit(": "), billions_text(home_value), F.lit(" USD<br>"),
        col(entity), F.lit(" GDP in "), when, F.lit(": "), billions_text(value), F.lit(" USD"),
    )
    missing = F.concat(F.lit("GDP data not available for "), col(entity), F.lit(" in "), when)
    return F.coalesce(present, missing)
