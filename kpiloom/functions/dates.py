"""Calendar keys at day grain. Every function that needs "today" takes it as a parameter."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.functions.text import column


def day(c: Column | str) -> Column:
    return F.to_date(column(c))


def month_start(c: Column | str) -> Column:
    return F.trunc(column(c), "month")


def week_start(c: Column | str) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(column(c), "week")


def year_month(c: Column | str) -> Column:
    return F.date_format(column(c), "yyyy-MM")


def yyyymm(c: Column | str) -> Column:
    c = column(c)
    return F.year(c) * 100 + F.month(c)


def next_yyyymm(c: Column | str) -> Column:
    """Following month of a yyyymm integer."""
    c = column(c)
    return F.when(c % 100 == 12, c + 89).otherwise(c + 1)


def previous_yyyymm(c: Column | str) -> Column:
    c = column(c)
    return F.when(c % 100 == 1, c - 89).otherwise(c - 1)


def iso_text(c: Column | str) -> Column:
    return F.date_format(column(c), "yyyy-MM-dd")


def iso_day(c: Column | str) -> Column:
    """Day part of an ISO date-time text."""
    return F.split_part(column(c), F.lit("T"), F.lit(1))


def sheet_year(c: Column | str, separator: str) -> Column:
    """Year of a ``d<sep>m<sep>y`` text; two digits count from 2000."""
    part = F.split_part(column(c), F.lit(separator), F.lit(3))
    year = part.cast("int")
    return F.when(F.length(part) == 2, year + 2000).otherwise(year)


def block_index(d: Column | str, launch: Column | str, days: int = 7) -> Column:
    """Number of the ``days``-day block counted from the launch day; days before it give negative blocks."""
    return F.floor(F.date_diff(column(d), column(launch)) / days).cast("int")


def block_complete(block: Column | str, launch: Column | str, as_of: date, days: int = 7) -> Column:
    """True where the block has ended by ``as_of``."""
    return F.date_add(column(launch), days * (column(block) + 1)) <= F.lit(as_of)


def launch_of(country: Column | str, launches: Mapping[str, date]) -> Column:
    """Launch day of a country from the rollout table, NULL where it was not launched."""
    pairs = [F.lit(x) for pair in launches.items() for x in pair]
    return F.create_map(*pairs)[column(country)]
