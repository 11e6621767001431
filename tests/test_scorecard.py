import pytest
from pyspark.sql import functions as F

from kpiloom.functions import fixed
from kpiloom.operators import scorecard
from tests.conftest import d, rows


@pytest.mark.parametrize(
    ("actual", "target", "inverted", "want"),
    [(50.0, 100.0, False, 50.0), (50.0, 100.0, True, 200.0), (0.0, 100.0, True, 130.0), (0.0, 100.0, False, 0.0), (None, 1.0, False, None), (1.0, None, True, None), (1.0, 0.0, False, None), (0.0, 0.0, True, None)],
)
def test_attainment(one, actual, target, inverted, want):
    assert one(scorecard.attainment(F.lit(actual).cast("double"), F.lit(target).cast("double"), F.lit(inverted))) == want


@pytest.mark.parametrize(
    ("pct", "counts", "band", "note"),
    [(69.99, 0.0, "bad", "floored"), (70.0, 70.0, "bad", None), (80.0, 80.0, "warn", None), (99.9, 99.9, "warn", None), (100.0, 100.0, "ok", None), (131.0, 130.0, "ok", "capped"), (None, None, "na", None)],
)
def test_bands(one, pct, counts, band, note):
    p = F.lit(pct).cast("double")
    assert one(scorecard.effective(p), scorecard.band(p), scorecard.band_note(p)) == (counts, band, note)


MONTHS = ("2026-04", "2026-05", "2026-06", "2026-07", "2026-08", "2026-09")
BOARD = (("a", "es", 7, True, (20,) * 6), ("b", "ce", 13, False, (100,) * 6), ("c", "ce", 16, False, (50,) * 6))


@pytest.fixture(scope="module")
def actuals(spark):
    data = [("a", "2026-04", 10.0), ("a", "2026-05", 25.0), ("b", "2026-04", 60.0), ("b", "2026-05", 110.0), ("c", "2026-04", 50.0), ("b", "2026-06", 500.0), ("c", "2026-07", 10.0)]
    return spark.createDataFrame(data, "id string, month string, actual double")


def scores(spark, actuals, closed_only, as_of="2026-06-15"):
    return scorecard.month_scores(scorecard.board_table(spark, BOARD), scorecard.target_table(spark, MONTHS, BOARD), actuals, d(as_of), closed_only)


def test_closed_months_only(spark, actuals):
    got = {(r.id, r.month): r for r in scores(spark, actuals, True).collect()}
    assert len(got) == 18
    assert got["a", "2026-04"].pct == 200.0 and got["a", "2026-05"].pct == 80.0
    assert got["b", "2026-06"].actual == 500.0 and got["b", "2026-06"].pct is None and got["b", "2026-06"].band is None
    assert got["c", "2026-07"].actual is None and got["c", "2026-05"].band == "na"


def test_current_month_is_partial(spark, actuals):
    got = {(r.id, r.month): r for r in scores(spark, actuals, False).collect()}
    assert got["b", "2026-06"].pct == 500.0 and got["b", "2026-06"].partial and not got["b", "2026-05"].partial
    assert not got["a", "2026-06"].partial and got["c", "2026-07"].pct is None


def test_weighted_months_renormalise(spark, actuals):
    got = {r.period: r.pct for r in scorecard.weighted_total(scores(spark, actuals, True)).collect()}
    april = (130 * 7 + 0 * 13 + 100 * 16) / 36  # 200% is capped, 60% counts nothing
    may = (80 * 7 + 110 * 13) / 20  # metric c has no actual
    assert got["2026-04"] == pytest.approx(april) and got["2026-05"] == pytest.approx(may) and got["2026-06"] is None
    assert got["q1"] == pytest.approx((april + may) / 2) == got["half"] and got["q2"] is None


def test_span_means_are_not_capped(spark, actuals):
    got = {(r.id, r.span): r.pct for r in scorecard.span_means(scores(spark, actuals, True), ["id"], "pct").collect()}
    assert got["a", "q1"] == 140.0 and got["b", "half"] == 85.0 and got["c", "q2"] is None


def test_zero_weight_does_not_count(spark, actuals):
    board = scorecard.board_table(spark, (("a", "es", 0, True, (20,) * 6), ("b", "ce", 1, False, (100,) * 6)))
    targets = scorecard.target_table(spark, MONTHS, BOARD)
    got = {r.period: r.pct for r in scorecard.weighted_total(scorecard.month_scores(board, targets, actuals, d("2026-06-15"))).collect()}
    assert got["2026-05"] == pytest.approx(110.0)


def test_weight_shares_end_at_one_hundred(spark):
    shares = {r.id: r.share for r in scorecard.weight_shares(scorecard.board_table(spark, BOARD)).collect()}
    assert shares == {"a": 19.4, "b": 36.1, "c": 44.5}
    plain = {r.id: r.share for r in scorecard.weight_shares(scorecard.board_table(spark, fixed.SECOND_HALF_BOARD), fill_last=False).collect()}
    assert plain == {"kr11": 33.3, "kr12": None, "kr21": 33.3, "kr22": 33.3}


def test_progress_of_the_latest_month(spark, actuals):
    board, targets = scorecard.board_table(spark, BOARD), scorecard.target_table(spark, MONTHS, BOARD)
    got = {r.id: r for r in scorecard.progress(board, targets, actuals, d("2026-05-20")).collect()}
    assert (got["a"].delta, got["a"].good, got["a"].bar) == (-5.0, False, 80.0)
    assert (got["b"].delta, got["b"].good, got["b"].bar) == (10.0, True, 100.0)
    assert got["c"].pct is None and got["c"].bar == 0.0 and got["c"].band == "na"
    early = {r.month for r in scorecard.progress(board, targets, actuals, d("2026-01-20")).collect()}
    late = {r.month for r in scorecard.progress(board, targets, actuals, d("2027-01-20")).collect()}
    assert early == {"2026-04"} and late == {"2026-09"}


def test_row_target_comes_before_the_constant(spark):
    targets = scorecard.target_table(spark, MONTHS, BOARD)
    own = spark.createDataFrame([("b", "2026-04", 7.0), ("b", "2026-05", None)], "id string, month string, target double")
    got = {(r.id, r.month): r.target for r in scorecard.row_targets(targets, own).collect()}
    assert got["b", "2026-04"] == 7.0 and got["b", "2026-05"] == 100.0 and got["a", "2026-04"] == 20.0


def test_timeout_share_counts_every_status(spark):
    df = spark.createDataFrame([(d("2026-04-01"), "Time_out_client", 2), (d("2026-04-01"), "CONFIRMED", 6), (d("2026-05-01"), "CONFIRMED", 3)], "mes_deadline date, status string, reservas long")
    assert [(r[0], float(r[1])) for r in rows(scorecard.timeout_share(df))] == [(d("2026-04-01"), 25.0), (d("2026-05-01"), 0.0)]


def test_weekly_attainment_stops_before_this_week(spark):
    weeks = spark.createDataFrame([("a", d("2026-03-30"), 1.0), ("a", d("2026-04-06"), 10.0), ("a", d("2026-04-13"), 40.0), ("b", d("2026-04-06"), None)], "id string, semana_inicio date, value double")
    got = scorecard.weekly_attainment(weeks, scorecard.target_table(spark, MONTHS, BOARD), scorecard.board_table(spark, BOARD), d("2026-04-15"), "2026-04")
    assert {(r.id, r.pct, r.band) for r in got.collect()} == {("a", 200.0, "ok"), ("b", None, "na")}


def test_monitor_cards(spark):
    weeks = spark.createDataFrame([("a", d("2026-04-06"), 5.0), ("a", d("2026-04-13"), 9.0), ("a", d("2026-04-20"), 9.0), ("a", d("2026-05-04"), 2.0), ("a", d("2026-05-11"), None)], "id string, semana_inicio date, value double")
    r = scorecard.monitor_cards(weeks, scorecard.target_table(spark, MONTHS, BOARD)).first()
    assert (r.best, r.best_week, r.worst, r.worst_week) == (9.0, d("2026-04-13"), 2.0, d("2026-05-04"))
    assert (r["last"], r.month, r.target, r.gap, r.weeks_in_month) == (2.0, "2026-05", 20.0, -18.0, 1)
    assert r.mean_complete == pytest.approx(23 / 3)


def test_frequency_cards(spark):
    monthly = spark.createDataFrame([(202604, 30.0), (202605, 36.0), (202606, 36.0)], "mes_evaluacion int, pct_aumento double")
    now = scorecard.frequency_cards(monthly, d("2026-06-10")).first()
    assert (now.best, now.best_month, now["last"], now.last_good, now.current) == (36.0, 202605, 36.0, True, 36.0)
    assert scorecard.frequency_cards(monthly, d("2026-07-10")).first().current == 0.0
