"""Running counts that remember what they have seen, so a day's refresh reads that day only.

The state of a running count is a row per (period, entity) with its first steps (``cumulative.first_steps``), kept in a
store with a part per period. New days are reduced to such rows and merged with the parts of the periods they fall in;
other periods are not read. Merging the same days twice changes nothing, so a lost run is just repeated.

A state only grows: rows that are taken back, or that change their status later, need the full computation. Rows that come
late are merged by starting again from their day (``again_from``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators import cohort
from kpiloom.operators.cumulative import first_steps, merged_steps
from kpiloom.plans import first_half, second_half
from kpiloom.plans.settings import Settings
from kpiloom.sources.tables import Tables
from kpiloom.sources.versions import Store


@dataclass(frozen=True)
class Running:
    """``rows`` gives the rows of the days since..until; ``counts`` the figures from the state; ``start`` the first day."""

    rows: Callable[[Tables, Settings, date, date], DataFrame]
    counts: Callable[[DataFrame], DataFrame]
    start: Callable[[Settings], date]
    period: str
    step: str
    entity: str
    marks: Mapping[str, Column] = field(default_factory=dict)


def _both_sides(t: Tables, s: Settings, since: date, until: date) -> DataFrame:
    return cohort.activation_rows(*first_half.weekly_sides(t, s, since, until), "mes_inicio", "semana_inicio", "agency")


def running_counts() -> dict[str, Running]:
    """The metrics whose rows only grow, by the name of their board and key."""
    return {
        "h1.kr22_sem_cum": Running(
            first_half.agency_requests, first_half.requests_so_far, lambda s: date.fromisoformat(f"{min(s.request_week_months)}-01"),
            "mes_inicio", "semana_inicio", "agency_code",
        ),
        "h1.kr32_sem_cum": Running(
            _both_sides, first_half.activation_so_far, lambda s: s.weeks_from, "mes_inicio", "_q", "agency", {"sold": F.col("_s")}
        ),
        "h2.kr21_sem": Running(
            second_half.weekly_quotes, second_half.quoting_so_far, lambda s: s.quoting_from, "mes", "semana_inicio", "agency"
        ),
    }


def seen_until(store: Store) -> date | None:
    """The last day that the state holds."""
    days = [part.note["until"] for part in store.parts().values()]
    return date.fromisoformat(max(days)) if days else None


def advance(spark: SparkSession, name: str, t: Tables, s: Settings, path: str, until: date, again_from: date | None = None) -> bool:
    """Merge the days after those of the state, up to ``until``; False when there are none.

    ``again_from``: also the days from this one on, though the state holds them.
    """
    kind, store = running_counts()[name], Store(spark, path)
    done = seen_until(store)
    since = kind.start(s) if done is None else done + timedelta(days=1)
    since = min(since, again_from) if again_from else since
    if since > until:
        return False
    new = first_steps(kind.rows(t, s, since, until), kind.period, kind.step, kind.entity, kind.marks)
    new = new.where(F.col(kind.period).isNotNull())
    keys = _periods(since, until)
    known = [k for k in keys if k in store.parts()]
    merged = merged_steps(store.read(*known).unionByName(new), kind.period, kind.entity) if known else new
    period = F.date_format(kind.period, "yyyy-MM-dd")
    parts = store.stage(merged, period, keys, {k: {"until": max(until, done or until).isoformat()} for k in keys})
    store.publish(parts)
    return True


def _periods(since: date, until: date) -> list[str]:
    """First days of the months of since..until."""
    months, day = [], since.replace(day=1)
    while day <= until:
        months.append(day.isoformat())
        day = (day + timedelta(days=31)).replace(day=1)
    return months


def current(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The figures up to the last day that was merged."""
    store = Store(spark, path)
    return running_counts()[name].counts(store.read(*sorted(store.parts())))
