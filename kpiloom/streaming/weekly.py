"""Weekly increment of the usage store.

There is no stream to read; this is a batch job: find the weeks that closed and are missing, or whose sources have changed
since, compute them, replace them in the store and let the oldest go, all in one step.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions import dates, fixed
from kpiloom.operators import calendar, changes, funnel
from kpiloom.operators.tables import inline
from kpiloom.plans import usability
from kpiloom.plans.settings import Settings
from kpiloom.sources import snapshots
from kpiloom.sources.tables import Tables
from kpiloom.sources.versions import Store


PRODUCTS = tuple(dict.fromkeys(label for label, _ in fixed.USAGE_PRODUCTS.values()))
COUNTRIES = (*fixed.USAGE_COUNTRIES, fixed.OTHER_USAGE_COUNTRY)


def closed_weeks(spark: SparkSession, s: Settings, weeks: int = fixed.WEEKS_KEPT) -> DataFrame:
    """The latest ``weeks`` closed weeks; older ones leave the store and are not fetched again."""
    closed = calendar.closed_periods(spark, s.anchor, s.as_of, 7, fixed.WEEK_MARGIN_DAYS)
    return closed.orderBy(F.col("week_start").desc()).limit(weeks)


def weeks_to_fetch(spark: SparkSession, s: Settings, store: DataFrame, recompute: int = 0) -> DataFrame:
    return calendar.periods_to_fetch(closed_weeks(spark, s), store, recompute)


def increment(t: Tables, s: Settings, weeks: Sequence[date]) -> DataFrame:
    """Usage of the given weeks, with a row for every week, product and country. Only these weeks are read."""
    runs: list[list[date]] = []
    for week in sorted(weeks):
        if runs and runs[-1][-1] + timedelta(days=7) == week:
            runs[-1].append(week)
        else:
            runs.append([week])
    usage = None
    for run in runs:  # weeks in a row are one scan
        part = usability.filter_usage(t, s, run[0], run[-1] + timedelta(days=6))
        usage = part if usage is None else usage.unionByName(part)
    return snapshots.zero_filled(usage, PRODUCTS, COUNTRIES, weeks=sorted(weeks))


def source_marks(t: Tables, s: Settings, since: date, until: date) -> DataFrame:
    """Rows and a mark of what the usage reads of each source, per week; a scan with one small aggregation."""
    pages = funnel.clean_pages(t.traffic, s.channels).where(F.col("date").between(since.isoformat(), until.isoformat()))
    seen = ("product", "flow", "country", "visit", "pageview_id")
    out = changes.period_marks(pages, calendar.period_of(F.to_date("date"), s.anchor), seen).withColumn("source", F.lit("traffic"))
    for role in ("map_a_events", "map_b_events", "array_events", "label_events"):
        events = funnel.in_window(getattr(t, role), since, until)
        week = calendar.period_of(F.to_date(dates.iso_day("datetime")), s.anchor)
        out = out.unionByName(changes.period_marks(events, week, ("datetime", "event")).withColumn("source", F.lit(role)))
    return out


def notes_of(t: Tables, s: Settings, weeks: Sequence[date]) -> dict[date, dict[str, list]]:
    """What to note of each week's sources; at most the weeks kept, times five sources, come to the driver."""
    out: dict[date, dict[str, list]] = {week: {} for week in weeks}
    if weeks:
        for row in source_marks(t, s, min(weeks), max(weeks) + timedelta(days=6)).collect():
            if row["period"] in out:
                out[row["period"]][row["source"]] = [row["n"], str(row["mark"])]
    return out


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The store, None before the first refresh."""
    store = Store(spark, path)
    keys = sorted(store.parts())
    return store.read(*keys) if keys else None


def refresh(spark: SparkSession, t: Tables, s: Settings, path: str, recompute: int = 0, changed: bool = False) -> bool:
    """Bring the store up to date; False when nothing was missing.

    Missing weeks and the last ``recompute`` ones are computed and replaced, also where nothing is left of them; weeks
    beyond those kept leave the store. With ``changed`` the sources of all kept weeks are marked, and weeks whose marks
    differ from those of the last refresh (or that were stored without) are computed again, however old.
    """
    store = Store(spark, path)
    parts = store.parts()
    known = inline(spark, [(date.fromisoformat(week),) for week in parts], "week_start date")
    # at most the weeks kept
    wanted = {r[0] for r in weeks_to_fetch(spark, s, known, recompute).collect()}
    notes = {}
    if changed:
        notes = notes_of(t, s, [r[0] for r in closed_weeks(spark, s).collect()])
        wanted |= {w for w, note in notes.items() if w.isoformat() in parts and parts[w.isoformat()].note != note}
    if not wanted:
        return False
    snapshots.refresh_weeks(store, increment(t, s, sorted(wanted)), sorted(wanted), {w: n for w, n in notes.items() if w in wanted})
    return True


def current(spark: SparkSession, path: str, weeks: int = fixed.WEEKS_KEPT) -> DataFrame:
    """The latest weeks of the store."""
    store = Store(spark, path)
    return store.read(*sorted(store.parts())[-weeks:])
