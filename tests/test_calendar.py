from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import calendar
from tests.conftest import d, rows


def test_calendar_shows_started_weeks_only(spark):
    weeks = calendar.expand_calendar(calendar.commercial_calendar(spark), d("2026-11-04")).collect()
    by_key = {(w.periodo, w.semana): w for w in weeks}
    assert set(by_key) == {("2026-10", k) for k in (1, 2, 3, 4)} | {("2026-11", 1)}
    fourth, running = by_key["2026-10", 4], by_key["2026-11", 1]
    assert (fourth.s_desde, fourth.s_hasta, fourth.foto, fourth.estado) == (d("2026-10-26"), d("2026-11-01"), d("2026-11-02"), "CIERRE")
    assert (running.foto, running.estado) == (d("2026-11-04"), "EN_CURSO")


def test_five_week_month(spark):
    weeks = calendar.expand_calendar(calendar.commercial_calendar(spark), d("2027-04-01"))
    assert {r.periodo: r["count"] for r in weeks.groupBy("periodo").count().collect()}["2026-12"] == 5


def state(spark, ordered, confirmed, cancelled, as_of="2026-11-30"):
    weeks = calendar.expand_calendar(calendar.commercial_calendar(spark), d(as_of))
    orders = spark.createDataFrame([("A", d(ordered), confirmed and d(confirmed), cancelled and d(cancelled))], "agencia_id string, rd date, cd date, xd date")
    return {r.semana: (r.w, r.conf, r.viva) for r in calendar.asof_state(orders, weeks).where("periodo = '2026-10'").collect()}


def test_order_counts_from_its_own_week_on(spark):
    assert state(spark, "2026-10-11", "2026-10-11", None) == {k: (1, 1, 1) for k in (1, 2, 3, 4)}
    assert state(spark, "2026-10-12", "2026-10-12", None) == {k: (2, 1, 1) for k in (2, 3, 4)}


def test_state_on_the_photo_date(spark):
    # photo of the first week: 2026-10-12; a cancellation on that day counts, one day later it does not yet
    assert state(spark, "2026-10-06", "2026-10-06", "2026-10-12")[1] == (1, 0, 0)
    assert state(spark, "2026-10-06", "2026-10-06", "2026-10-13")[1] == (1, 1, 1)
    assert state(spark, "2026-10-06", "2026-10-13", None)[1] == (1, 0, 1)
    assert state(spark, "2026-10-06", "2026-10-13", None)[2] == (1, 1, 1)
    assert state(spark, "2026-10-06", None, None)[4] == (1, 0, 1)


def test_frequent_buyers_need_three_distinct_weeks(spark):
    weeks = calendar.expand_calendar(calendar.commercial_calendar(spark), d("2026-11-02"))
    days = {"three": ("2026-10-05", "2026-10-12", "2026-10-19"), "same": ("2026-10-05", "2026-10-06", "2026-10-12"), "late": ("2026-10-26",)}
    orders = spark.createDataFrame([(a, d(x), d(x), None) for a, xs in days.items() for x in xs], "agencia_id string, rd date, cd date, xd date")
    got = {r.semana: (r.frecuentes_conf, r.compradoras_conf, r.compradoras_semana) for r in calendar.frequent_buyers(calendar.asof_state(orders, weeks)).where("periodo = '2026-10'").collect()}
    assert got == {1: (0, 2, 2), 2: (0, 2, 2), 3: (1, 2, 1), 4: (1, 3, 1)}


@pytest.mark.parametrize(("as_of", "count"), [("2026-09-03", 0), ("2026-09-04", 1), ("2026-09-10", 1), ("2026-09-11", 2)])
def test_week_closes_one_day_after_its_end(spark, as_of, count):
    # anchor 2026-08-28: its week ends on 2026-09-03
    weeks = calendar.closed_periods(spark, d("2026-08-28"), d(as_of), 7, 1)
    assert rows(weeks) == [(d("2026-08-28") + timedelta(days=7 * i),) for i in range(count)]


def test_weeks_to_fetch(spark):
    closed = calendar.closed_periods(spark, d("2026-08-28"), d("2026-10-01"), 7, 1)
    store = spark.createDataFrame([(d("2026-08-28"),), (d("2026-09-11"),), (d("2026-09-18"),)], "week_start date")
    assert rows(calendar.periods_to_fetch(closed, store)) == [(d("2026-09-04"),)]
    assert set(rows(calendar.periods_to_fetch(closed, store, 2))) == {(d("2026-09-04"),), (d("2026-09-11"),), (d("2026-09-18"),)}


def test_period_of_days_before_the_anchor(one):
    anchor = date(2026, 8, 28)
    assert one(*[calendar.period_of(F.date_add(F.lit(anchor), n), anchor) for n in (0, 6, 7, -1)]) == (
        anchor, anchor, anchor + timedelta(days=7), anchor - timedelta(days=7),
    )


def test_symmetric_window():
    assert calendar.symmetric_window(d("2026-10-13"), d("2026-10-20")) == (7, d("2026-10-06"))


def test_grains_are_not_additive(spark):
    df = spark.createDataFrame([(d("2026-11-12"), "v"), (d("2026-11-13"), "v"), (d("2026-11-16"), "v")], "day date, visit string")
    got = calendar.by_grains(df, "day").select("grain", "p", "visit").distinct().groupBy("grain").count()
    assert {r.grain: r["count"] for r in got.collect()} == {"d": 3, "w": 2, "m": 1, "t": 1}
