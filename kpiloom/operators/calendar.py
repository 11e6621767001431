"""Calendars, closed periods and as-of order states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions import dates, fixed
from kpiloom.functions.text import column
from kpiloom.operators.tables import inline


def commercial_calendar(spark: SparkSession, rows: Sequence[Sequence] = fixed.COMMERCIAL_CALENDAR) -> DataFrame:
    return inline(spark, rows, "periodo string, desde date, hasta date, n_sem int")


def expand_calendar(calendar: DataFrame, as_of: date) -> DataFrame:
    """One row per commercial week that has started: its days, the photo date and whether it is closed."""
    today = F.lit(as_of)
    weeks = calendar.select(
        "periodo", "n_sem", F.col("desde").alias("m_desde"), F.explode(F.sequence(F.lit(1), F.col("n_sem"))).alias("semana")
    )
    start = F.date_add("m_desde", 7 * (F.col("semana") - 1))
    after = F.date_add("m_desde", 7 * F.col("semana"))
    return F.broadcast(
        weeks.select(
            "periodo", "n_sem", "m_desde", "semana",
            start.alias("s_desde"), F.date_add(start, 6).alias("s_hasta"),
            F.least(after, today).alias("foto"),
            F.when(after <= today, fixed.CLOSED_STATE).otherwise(fixed.RUNNING_STATE).alias("estado"),
        ).where(F.col("s_desde") <= today)
    )


def asof_state(orders: DataFrame, weeks: DataFrame) -> DataFrame:
    """Every order under each commercial week that covers it, with its state on the photo date of that week.

    ``orders``: agencia_id, rd (ordered), cd (confirmed), xd (cancelled). An order lies in the weeks of its month from
    its own week on. The calendar is spread to days first, so the order date meets it by equality.
    Adds ``w`` (the order's own week), ``conf`` (confirmed by then and not cancelled) and ``viva`` (not cancelled).
    """
    days = weeks.select(
        "periodo", "semana", "foto", "m_desde", F.explode(F.sequence("m_desde", "s_hasta")).alias("rd")
    ).select("periodo", "semana", "foto", "rd", (F.floor(F.date_diff("rd", "m_desde") / 7) + 1).cast("int").alias("w"))
    alive = F.col("xd").isNull() | (F.col("xd") > F.col("foto"))
    confirmed = F.coalesce(F.col("cd") <= F.col("foto"), F.lit(False))
    return orders.join(F.broadcast(days), "rd").withColumns(
        {"conf": (confirmed & alive).cast("int"), "viva": alive.cast("int")}
    )


def buying_weeks(states: DataFrame) -> DataFrame:
    """Per (period, week, agency): number of distinct weeks bought so far, confirmed and alive, and bought this week.

    Weeks are collected in a bit set, which merges map-side; a row per order never reaches the shuffle of a large agency.
    """
    bit = F.expr("shiftleft(1L, w - 1)")
    grouped = states.groupBy("periodo", "semana", "agencia_id").agg(
        F.bit_or(F.when(F.col("conf") == 1, bit)).alias("_conf"),
        F.bit_or(F.when(F.col("viva") == 1, bit)).alias("_viva"),
        F.max(F.when((F.col("conf") == 1) & (F.col("w") == F.col("semana")), 1).otherwise(0)).alias("compro_semana"),
    )
    return grouped.select(
        "periodo", "semana", "agencia_id", "compro_semana",
        F.coalesce(F.bit_count("_conf"), F.lit(0)).alias("sc"),
        F.coalesce(F.bit_count("_viva"), F.lit(0)).alias("sv"),
    )


def frequent_buyers(states: DataFrame, at_least: int = fixed.FREQUENT_WEEKS) -> DataFrame:
    """Agencies per (period, week): frequent and buying, confirmed and alive, and buying in the week itself."""

    def agencies(predicate: Column) -> Column:
        return F.count(F.when(predicate, F.col("agencia_id")))

    return buying_weeks(states).groupBy("periodo", "semana").agg(
        agencies(F.col("sc") >= at_least).alias("frecuentes_conf"),
        agencies(F.col("sv") >= at_least).alias("frecuentes_vivas"),
        agencies(F.col("sc") >= 1).alias("compradoras_conf"),
        agencies(F.col("sv") >= 1).alias("compradoras_vivas"),
        agencies(F.col("compro_semana") == 1).alias("compradoras_semana"),
    )


def last_step(df: DataFrame, period: str, step: str, values: Sequence[str]) -> DataFrame:
    """The row of the last step of each period."""
    return df.groupBy(period).agg(
        F.max(step).alias(step), *[F.max_by(v, step).alias(v) for v in values]
    )


def closed_periods(spark: SparkSession, anchor: date, as_of: date, days: int = 7, margin: int = 0) -> DataFrame:
    """First days of the periods from ``anchor`` that ended at least ``margin`` days before ``as_of``."""
    periods = max((as_of - anchor).days + 1 - margin, 0) // days
    if periods == 0:
        return spark.createDataFrame([], "week_start date")
    return spark.range(0, periods, 1, 1).select(F.date_add(F.lit(anchor), (F.col("id") * days).cast("int")).alias("week_start"))


def period_of(d: Column | str, anchor: date, days: int = 7) -> Column:
    """First day of the period that holds ``d``, counted from the anchor."""
    d = column(d)
    return F.date_add(F.lit(anchor), (F.floor(F.date_diff(d, F.lit(anchor)) / days) * days).cast("int"))


def missing_periods(closed: DataFrame, store: DataFrame, key: str = "week_start") -> DataFrame:
    """Closed periods that the store does not hold yet."""
    return closed.join(store.select(key).distinct(), key, "left_anti")


def periods_to_fetch(closed: DataFrame, store: DataFrame, recompute: int = 0, key: str = "week_start") -> DataFrame:
    """Missing periods and the last ``recompute`` closed ones. Both inputs are period lists."""
    missing = missing_periods(closed, store, key)
    if not recompute:
        return missing
    return missing.unionByName(closed.orderBy(F.col(key).desc()).limit(recompute)).distinct()


def symmetric_window(launch: date, as_of: date) -> tuple[int, date]:
    """Complete days since the launch and the first day of an equally long window before it."""
    days = (as_of - launch).days
    return days, launch - timedelta(days=days)


def by_grains(df: DataFrame, day: str, grains: Sequence[str] = ("d", "w", "m", "t")) -> DataFrame:
    """Each row once per time grain, with the text key of its period: day, week (Monday), month or total."""
    d = F.col(day)
    keys: Mapping[str, Column] = {
        "d": dates.iso_text(d),
        "w": dates.iso_text(dates.week_start(d)),
        "m": dates.year_month(d),
        "t": F.lit("total"),
    }
    periods = F.array(*[F.struct(F.lit(g).alias("grain"), keys[g].alias("p")) for g in grains])
    return df.select("*", F.inline(periods))
