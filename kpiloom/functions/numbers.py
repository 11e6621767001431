"""Ratios, rounding and money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.functions.text import column

MONEY = "decimal(24,6)"


def money(c: Column | str) -> Column:
    """Exact decimal, so that a distributed sum does not depend on the order of the rows."""
    return column(c).cast(MONEY)


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double, NULL for a zero denominator."""
    return column(num).cast("double") / F.nullif(column(den).cast("double"), F.lit(0.0))


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """100 * num / den rounded half up, NULL for a zero denominator."""
    return F.round(F.lit(100.0) * column(num) / F.nullif(column(den).cast("double"), F.lit(0.0)), digits)


def rounded(c: Column | str, digits: int = 0) -> Column:
    """Half-up rounding of an exact sum, handed over as double."""
    return F.round(column(c), digits).cast("double")


def half_even(c: Column | str) -> Column:
    """Half-even rounding to a whole number; digits past the sixth are noise of summing doubles."""
    return F.bround(F.round(column(c), 6), 0).cast("long")


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(column(c), F.lit(0))
