from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kpiloom.functions import dates
from kpiloom.operators import cohort, cumulative
from tests.conftest import d, rows

EVENTS = st.lists(st.tuples(st.integers(0, 75), st.one_of(st.none(), st.sampled_from("abcde")), st.booleans()), min_size=1, max_size=40)


def series(spark, data):
    start = date(2026, 10, 1)
    df = spark.createDataFrame([(start + timedelta(days=n), a, f) for n, a, f in data], "day date, a string, f boolean")
    return df.select(dates.month_start("day").alias("m"), dates.week_start("day").alias("w"), "a", "f", "day")


def brute(data, by_step):
    start = date(2026, 10, 1)
    base = set()
    for n, a, f in data:
        day = start + timedelta(days=n)
        base.add((day.replace(day=1), day - timedelta(days=day.weekday()), a, f))
    out = {}
    for m, w in {(m, w) for m, w, _, _ in base}:
        seen = [(a, f) for mm, ww, a, f in base if mm == m and ww <= w and a is not None]
        out.setdefault(w if by_step else (m, w), []).extend(seen)
    return {k: (len({a for a, _ in v}), len({a for a, f in v if f})) for k, v in out.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(EVENTS)
def test_first_seen_form_equals_the_range_self_join(spark, data):
    df = series(spark, data)
    got = cumulative.cumulative_distinct(df, "m", "w", "a", {"f": F.col("f")})
    assert {(r.m, r.w): (r.cumulative, r.cumulative_f) for r in got.collect()} == brute(data, False)
    merged = cumulative.cumulative_distinct(df, "m", "w", "a", {"f": F.col("f")}, by="step")
    assert {r.w: (r.cumulative, r.cumulative_f) for r in merged.collect()} == brute(data, True)


def test_week_in_two_months(spark):
    # 2026-10-26 is a Monday; that week ends on November 1st
    df = spark.createDataFrame(
        [(d("2026-10-27"), "x"), (d("2026-11-01"), "x"), (d("2026-11-01"), "y"), (d("2026-10-05"), "z")], "day date, a string"
    ).select(dates.month_start("day").alias("m"), dates.week_start("day").alias("w"), "a")
    straddling = d("2026-10-26")
    split = {(r.m, r.w): (r.in_step, r.cumulative) for r in cumulative.cumulative_distinct(df, "m", "w", "a").collect()}
    assert split == {(d("2026-10-01"), d("2026-10-05")): (1, 1), (d("2026-10-01"), straddling): (1, 2), (d("2026-11-01"), straddling): (2, 2)}
    merged = {r.w: r.cumulative for r in cumulative.cumulative_distinct(df, "m", "w", "a", by="step").collect()}
    assert merged == {d("2026-10-05"): 1, straddling: 3}


def test_last_cumulative_is_the_month(spark):
    df = spark.range(500).select(F.date_add(F.lit(d("2026-10-01")), (F.col("id") % 31).cast("int")).alias("day"), (F.col("id") % 37).alias("a"))
    df = df.select(dates.month_start("day").alias("m"), dates.week_start("day").alias("w"), "a")
    last = cumulative.cumulative_distinct(df, "m", "w", "a").groupBy("m").agg(F.max_by("cumulative", "w"))
    assert rows(last) == rows(df.groupBy("m").agg(F.count_distinct("a")))


def test_cumulative_sum_and_its_differences(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 7), (2, 2, 1), (1, 2, 1)], "m int, w int, v int")
    out = cumulative.cumulative_sum(df, "m", "w", "v")
    assert rows(out.select("m", "w", "cumulative")) == [(1, 1, 5), (1, 2, 13), (2, 2, 1)]
    assert rows(cumulative.step_values(out, "m", "w", ["cumulative"]).select("m", "w", "cumulative")) == [(1, 1, 5), (1, 2, 8), (2, 2, 1)]
    assert rows(cumulative.cumulative_sum(df, "m", "w", "v", by="step").select("w", "cumulative")) == [(1, 5), (2, 14)]


def test_worsening_needs_two_in_a_row(spark):
    df = spark.createDataFrame(
        [("up", 1, 1.0), ("up", 2, 2.0), ("up", 3, 3.0), ("down", 1, 3.0), ("down", 2, 2.0), ("down", 3, 1.0), ("mixed", 1, 1.0), ("mixed", 2, 3.0),
         ("mixed", 3, 2.0), ("short", 1, 1.0), ("two", 1, 2.0), ("two", 2, 1.0), ("gap", 1, 3.0), ("gap", 2, 2.0), ("gap", 3, None), ("gap", 4, 1.0)],
        "id string, w int, v double",
    )
    flags = {r.id: r.declining for r in cumulative.worsening(df, "id", "w", "v", F.lit(False)).collect()}
    assert flags == {"up": False, "down": True, "mixed": False, "two": False, "gap": True}
    inverted = {r.id: r.declining for r in cumulative.worsening(df, "id", "w", "v", F.lit(True)).collect()}
    assert inverted["up"] is True and inverted["down"] is False


def test_mean_leaves_the_latest_week_out(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("a", 3, 100.0), ("b", 1, 9.0)], "id string, w int, v double")
    assert rows(cumulative.mean_without_latest(df, "id", "w", "v")) == [("a", 3.0), ("b", 0.0)]


def test_activation_counts_sellers_that_quoted(spark):
    quotes = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c")], "m int, e string")
    sales = spark.createDataFrame([(1, "a"), (1, "z"), (2, "b")], "m int, e string")
    assert rows(cohort.activation(quotes, sales, "m", "e")) == [(1, 2, 1, 3, 50.0), (2, 1, 0, 1, 0.0)]


def test_activation_accumulates_the_later_of_quote_and_sale(spark):
    day = lambda n: date(2026, 10, 5) + timedelta(days=7 * n)
    month = date(2026, 10, 1)
    quotes = spark.createDataFrame([(month, day(0), "a"), (month, day(1), "b"), (month, day(3), "c")], "m date, w date, e string")
    sales = spark.createDataFrame([(month, day(2), "a"), (month, day(0), "b"), (month, day(1), "z")], "m date, w date, e string")
    got = {r.w: (r.cumulative, r.cumulative_sold) for r in cohort.activation_cumulative(quotes, sales, "m", "w", "e").collect()}
    assert got == {day(0): (1, 0), day(1): (2, 1), day(3): (3, 2)}


def test_uplift(spark):
    bookings = spark.createDataFrame(
        [(202512, "a", 1), (202601, "a", 3), (202512, "b", 3), (202601, "b", 4), (202512, "c", 2), (202512, "d", 9), (202601, "d", 20), (202602, "e", 1)],
        "mes int, partner_id string, reservas long",
    )
    got = {r.mes_evaluacion: r for r in cohort.uplift(bookings, 25.0).collect()}
    january = got[202601]
    assert (january.mes_previo, january.agencias_total_previo, january.agencias_total_evaluado) == (202512, 4, 3)
    assert (january.agencias_1_3_previo, january.agencias_aumentaron, january.pct_aumento) == (3, 1, 33.33)
    assert january.pct_cumplimiento_target == 133.33
    assert got[202603].agencias_total_evaluado is None and got[202603].agencias_aumentaron == 0
    assert set(got) == {202601, 202602, 202603}


def test_uplift_in_a_shared_week(spark):
    monthly = spark.createDataFrame([(202609, "a", 1), (202610, "a", 3)], "mes int, partner_id string, reservas long")
    weekly = spark.createDataFrame(
        [(d("2026-10-12"), 202610, "a", 1), (d("2026-10-26"), 202610, "a", 2), (d("2026-10-26"), 202611, "a", 1)],
        "semana_inicio date, mes int, partner_id string, reservas long",
    )
    joined = {r.semana_inicio: (r.agencias_1_3_previo, r.agencias_aumentaron) for r in cohort.uplift_cumulative(monthly, weekly).collect()}
    assert joined == {d("2026-10-12"): (1, 0), d("2026-10-26"): (1, 1)}
    split = {(r.semana_inicio, r.mes): r.agencias_aumentaron for r in cohort.uplift_cumulative(monthly, weekly, match_month=True).collect()}
    assert split == {(d("2026-10-12"), 202610): 0, (d("2026-10-26"), 202610): 1, (d("2026-10-26"), 202611): 0}
