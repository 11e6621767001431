from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.functions import fixed
from kpiloom.operators import rollout
from kpiloom.plans import boards
from tests.conftest import d, rows

LAUNCH = {"AR": d("2026-10-13"), "MX": d("2026-09-29"), "US": d("2026-11-30")}


def test_only_launched_countries_and_days(spark):
    df = spark.createDataFrame([("AR", d("2026-10-12")), ("AR", d("2026-10-13")), ("UY", d("2026-12-01")), (None, d("2026-12-01"))], "c string, d date")
    assert rows(rollout.since_launch(df, LAUNCH)) == [("AR", d("2026-10-13"))]


def test_mix_blocks(spark):
    daily = spark.createDataFrame(
        [("2026-10-13", "AR", "Cash", 1, 10.0), ("2026-10-19", "AR", "Cash", 2, 0.5), ("2026-10-20", "AR", "Cash", 5, 1.0), ("2026-10-27", "AR", "Cash", 9, 1.0),
         ("2026-09-15", "AR", "Cash", 3, None), ("2026-09-14", "AR", "Cash", 4, 1.0)],
        "d string, c string, g string, n int, gb double",
    )
    got = rollout.mix_blocks(daily, LAUNCH, d("2026-10-27"))
    # block 0 sums 10.5 and rounds to the even 10; block 2 is not complete, block -5 is out of the window
    assert rows(got) == [("AR", -4, "Cash", 3, 0), ("AR", 0, "Cash", 3, 10), ("AR", 1, "Cash", 5, 1)]


def expected(values: dict[int, float], bmax: int, w: int):
    xs = np.arange(-w, 0)
    ys = np.array([values.get(int(x), 0.0) for x in xs])
    slope, intercept = np.polyfit(xs, ys, 1)
    sd = np.sqrt(((ys - intercept - slope * xs) ** 2).sum() / (w - 2))
    t = fixed.T_QUANTILES.get(w - 2, fixed.T_DEFAULT)
    out = {}
    for b in range(-w, bmax + 1):
        fit = intercept + slope * b
        half = t * sd * np.sqrt(1 + 1 / w + (b - xs.mean()) ** 2 / ((xs - xs.mean()) ** 2).sum()) if b >= 0 else 0.0
        out[b] = (values.get(b, 0.0), fit, max(0.0, fit - half), fit + half)
    return out


def test_counterfactual_against_numpy(spark):
    rng = np.random.default_rng(11)
    values = {b: float(round(v)) for b, v in zip(range(-16, 4), rng.normal(5000, 900, 20)) if b not in (-3, 1)}  # weeks without sale count as 0
    blocks = spark.createDataFrame([("total", "AR", b, v) for b, v in values.items()] + [("total", "US", -1, 5.0)], "series string, c string, b int, value double")
    got = {r.b: r for r in rollout.counterfactual(blocks).collect()}
    want = expected(values, 3, 12)
    assert set(got) == set(want)  # and no row of the country without a complete block since its launch
    for b, (actual, fit, low, high) in want.items():
        assert (got[b].actual, got[b].fit, got[b].low, got[b].high) == pytest.approx((actual, fit, low, high), abs=0.51)
    sums = {r.w: r.increment for r in rollout.increments(blocks).collect()}
    for w in fixed.FIT_WINDOWS:
        full = expected(values, 3, w)
        assert sums[w] == pytest.approx(sum(full[b][0] - full[b][1] for b in range(0, 4)), abs=0.51)


def test_refundable_series_is_the_difference(spark):
    daily = spark.createDataFrame([("2026-10-13", "AR", 40.0, 100.0), ("2026-10-14", "AR", None, 10.0)], "d string, c string, gl double, gt double")
    got = boards.link_counterfactual_blocks(daily, LAUNCH, d("2026-10-20"))
    assert rows(got) == [("nonref", "AR", 0, 40.0), ("ref", "AR", 0, 70.0), ("total", "AR", 0, 110.0)]


def test_band_has_no_width_before_the_launch(spark):
    blocks = spark.createDataFrame([("s", "AR", b, float(100 + b * b)) for b in range(-12, 2)], "series string, c string, b int, value double")
    for r in rollout.counterfactual(blocks).collect():
        assert (r.low == r.high == r.fit) if r.b < 0 else (r.low <= r.fit < r.high)


def test_countries_without_sale_are_zero(spark):
    country = spark.createDataFrame([("AR", "2026-10-13", 3, 50.0, 2, 1, 5.0, 1), ("ALL", "", 3, 50.0, 2, 1, 5.0, 1), ("TOT", "", 9, 90.0, 4, 4, 8.0, 0)], "c string, ld string, nl long, gl double, ag long, nc long, gc double, rep long")
    totals = spark.createDataFrame([("AR", 80.0, 5, 3), ("ALL", 80.0, 5, 3)], "c string, gt double, nt long, agt long")
    got = {r.c: r for r in boards.link_countries(country, totals, LAUNCH).collect()}
    assert set(got) == set(LAUNCH) and got["US"].nl == 0 and got["US"].gt == 0 and got["US"].ld == "2026-11-30"
    total = boards.link_total(country, totals).first()
    assert (total.nl, total.gt, total.hnc) == (3, 80.0, 4)


def test_wallet_board_sums_from_each_launch(spark):
    daily = spark.createDataFrame([("2026-10-12", "AR", 1, 5.0, 2, 9.0), ("2026-10-13", "AR", 1, None, 3, 9.0), ("2026-10-14", "AR", 2, 6.0, 3, 1.0)], "d string, c string, nw long, gw double, nt long, gt double")
    totals = spark.createDataFrame([("AR", 2, 4), ("ALL", 2, 4)], "c string, agw long, agt long")
    countries = boards.wallet_countries(daily, totals, LAUNCH)
    got = {r.c: (r.nw, r.gw, r.nt, r.gt, r.agw, r.agt) for r in countries.collect()}
    assert got["AR"] == (3, 6.0, 6, 10.0, 2, 4) and got["MX"] == (0, 0.0, 0, 0.0, 0, 0)
    assert tuple(boards.wallet_total(countries, totals).first()) == (3, 6.0, 6, 10.0, 2, 4)


def test_promise_countries_are_ranked(spark):
    sales = spark.createDataFrame([("AR", "TT", "C", 5.0), ("BR", "TT", "C", 9.0), ("BR", "HO", "C", 90.0), ("AR", "TT", "X", 99.0), (None, "TT", "C", 50.0), ("", "TT", "C", 40.0)], "c string, g string, st string, gb double")
    assert [r.c for r in boards.promise_countries(sales).collect()] == ["BR", "AR"]


def test_blocks_before_the_launch_are_negative(spark):
    start = LAUNCH["AR"]
    df = spark.createDataFrame([("AR", start + timedelta(days=n)) for n in (-8, -7, -1, 0, 6)], "c string, d date")
    got = rollout.with_blocks(rollout.with_launch(df, LAUNCH), d("2026-12-01"))
    assert [r.b for r in got.orderBy(F.col("d")).collect()] == [-2, -1, -1, 0, 0]
