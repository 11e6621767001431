"""Kept first-seen state against the full computation."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from checks import roles as R
from kpiloom.operators.cumulative import first_steps, merged_steps
from kpiloom.plans import first_half, second_half
from kpiloom.sources.versions import Store
from kpiloom.streaming import running
from tests.conftest import rows

FULL = {
    "h1.kr22_sem_cum": (lambda t: first_half.kr22_sem_cum(t, R.FIRST), R.FIRST, R.MAX_DAY),
    "h1.kr32_sem_cum": (lambda t: first_half.kr32_sem_cum(t, R.FIRST), R.FIRST, R.FIRST.weeks_to),
    "h2.kr21_sem": (lambda t: second_half.kr21_sem(t, R.SECOND), R.SECOND, R.SECOND.quoting_to),
}


@pytest.fixture(scope="module")
def tables(spark):
    return R.roles(spark, "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", FULL)
def test_three_portions_equal_the_whole_and_read_new_days_only(spark, tables, tmp_path, monkeypatch, name):
    full, settings, until = FULL[name]
    path, kind = str(tmp_path / "state"), running.running_counts()[name]
    asked = []
    noted = running.Running(
        lambda t, s, since, last: asked.append((since, last)) or kind.rows(t, s, since, last),
        kind.counts, kind.start, kind.period, kind.step, kind.entity, kind.marks,
    )
    monkeypatch.setattr(running, "running_counts", lambda: {name: noted})
    first = kind.start(settings)
    stops = [first + (until - first) * k // 3 for k in (1, 2, 3)]
    for stop in stops:
        assert running.advance(spark, name, tables, settings, path, stop)
        assert not running.advance(spark, name, tables, settings, path, stop)
    assert asked == [(first, stops[0]), *[(a + timedelta(days=1), b) for a, b in zip(stops, stops[1:])]]
    assert rows(running.current(spark, name, path)) == rows(full(tables))
    assert running.advance(spark, name, tables, settings, path, until, again_from=stops[1])  # once more changes nothing
    assert rows(running.current(spark, name, path)) == rows(full(tables))


def test_untouched_periods_are_not_rewritten_and_a_lost_run_is_repeated(spark, tables, tmp_path, monkeypatch):
    path, name = str(tmp_path / "state"), "h2.kr21_sem"
    first, until = R.SECOND.quoting_from, R.SECOND.quoting_to
    running.advance(spark, name, tables, R.SECOND, path, first + timedelta(days=60))
    before = Store(spark, path).parts()
    with monkeypatch.context() as m:
        m.setattr(Store, "publish", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            running.advance(spark, name, tables, R.SECOND, path, until)
    assert Store(spark, path).parts() == before
    running.advance(spark, name, tables, R.SECOND, path, until)
    after = Store(spark, path).parts()
    oldest = min(before)
    assert after[oldest] == before[oldest]
    assert rows(running.current(spark, name, path)) == rows(second_half.kr21_sem(tables, R.SECOND))


def test_portions_merge_in_any_order(spark):
    given = spark.range(400).select(
        (F.col("id") % 3).alias("p"), (F.col("id") * 7 % 11).alias("w"), F.when(F.col("id") % 13 > 0, F.col("id") % 13).alias("e"),
    ).withColumn("m", F.when(F.col("w") > 4, F.col("w")))
    whole = first_steps(given, "p", "w", "e", {"mark": F.col("m")})
    parts = [first_steps(given.where(F.col("w") % 3 == k), "p", "w", "e", {"mark": F.col("m")}) for k in (2, 0, 1, 0)]
    merged = merged_steps(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), "p", "e")
    ordered = [F.sort_array("steps").alias("steps")]
    assert rows(merged.select("p", "e", *ordered, "first", "mark")) == rows(whole.select("p", "e", *ordered, "first", "mark"))


def test_months(spark):
    assert running._periods(date(2026, 1, 31), date(2026, 3, 1)) == ["2026-01-01", "2026-02-01", "2026-03-01"]
