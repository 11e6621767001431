from datetime import date

import pytest
from pyspark.sql import functions as F

from kpiloom.functions import dates, fixed, numbers, text
from kpiloom.plans import first_half, initiatives
from tests.conftest import d


def test_test_names_are_case_blind_and_null_safe(one):
    names = ["Test Agency", "Contest", "plain", None]
    assert one(*[text.is_test_name(F.lit(n).cast("string")) for n in names]) == (True, True, False, False)


def test_strip_prefix(one):
    assert one(text.strip_prefix(F.lit("ext.ana"), "ext.", 5), text.strip_prefix(F.lit("ana"), "ext.", 5)) == ("ana", "ana")
    assert one(text.strip_prefix(F.lit("WLAG0012"), "WLAG", 3)) == "AG0012"


@pytest.mark.parametrize(
    ("fecha", "separator", "year"), [("5/3/2026", "/", 2026), ("5-3-26", "-", 2026), ("5-3-2025", "-", 2025), (None, "/", None)]
)
def test_sheet_year(one, fecha, separator, year):
    assert one(dates.sheet_year(F.lit(fecha), separator)) == year


def test_next_and_previous_month_cross_the_year(one):
    assert one(dates.next_yyyymm(F.lit(202512)), dates.next_yyyymm(F.lit(202506))) == (202601, 202507)
    assert one(dates.previous_yyyymm(F.lit(202601)), dates.previous_yyyymm(F.lit(202607))) == (202512, 202606)


@pytest.mark.parametrize(("offset", "block"), [(0, 0), (6, 0), (7, 1), (-1, -1), (-7, -1), (-8, -2)])
def test_blocks_before_the_launch_are_floored(one, offset, block):
    launch = date(2026, 10, 13)
    assert one(dates.block_index(F.date_add(F.lit(launch), offset), F.lit(launch))) == block


def test_block_is_complete_on_its_last_day_only(one):
    launch = F.lit(date(2026, 10, 13))
    assert one(dates.block_complete(F.lit(0), launch, d("2026-10-20"))) is True
    assert one(dates.block_complete(F.lit(0), launch, d("2026-10-19"))) is False


def test_rounding_modes(one):
    assert one(*[numbers.half_even(F.lit(v)) for v in (0.5, 1.5, 2.5, -0.5)]) == (0, 2, 2, 0)
    assert one(*[numbers.rounded(F.lit(v)) for v in (0.5, 1.5, 2.5)]) == (1.0, 2.0, 3.0)


@pytest.mark.parametrize(
    ("a", "b", "digits", "want"),
    [(7375, 7500, 1, 98.3), (7419, 7718, 1, 96.1), (2943, 3396, 1, 86.7), (2845, 3584, 1, 79.4), (4452, 6703, 1, 66.4),
     (4452, 6703, 2, 66.42), (807, 3508, 1, 23.0), (1, 0, 2, None), (None, 5, 2, None)],
)
def test_percentages(one, a, b, digits, want):
    assert one(numbers.pct(F.lit(a).cast("long"), F.lit(b), digits)) == want


def test_own_method_percentage(one):
    assert one(numbers.pct(F.lit(3219677.18), F.lit(3282530.45), 1)) == 98.1


def test_week_of_a_sunday_and_a_monday(one):
    assert one(dates.week_start(F.lit(d("2026-11-01"))), dates.week_start(F.lit(d("2026-11-02")))) == (d("2026-10-26"), d("2026-11-02"))


def test_year_month_is_not_compared_with_a_longer_text(one):
    # "2025-01" sorts before "2025-01-01", so a full date as bound drops the first month
    assert one(F.lit("2025-01") >= F.lit("2025-01-01")) is False


def fare(spark, rf, pm, fut, day):
    df = spark.createDataFrame([(rf, pm, fut, d(day), d("2026-10-13"))], "rf boolean, pm string, fut boolean, d date, ld date")
    return df.select(initiatives.fare_class()).first()[0]


def test_fare_classes(spark):
    assert fare(spark, False, "REMOTE_X", True, "2026-10-13") == "L"
    assert fare(spark, False, "REMOTE_X", True, "2026-10-12") == "N"
    assert fare(spark, False, "REMOTE_X", False, "2026-10-14") == "N"
    assert fare(spark, False, None, True, "2026-10-14") == "N"
    assert fare(spark, True, "REMOTE_X", True, "2026-10-14") == "R"
    assert fare(spark, None, "REMOTE_X", True, "2026-10-14") == "X"


def test_payment_mix_takes_the_first_text(spark):
    from checks.roles import IMPACT

    df = spark.createDataFrame(
        [
            ("REMOTE+WALLET", d("2026-10-10")), ("REMOTE", d("2026-10-01")), ("REMOTE", None), ("WALLET+AGENCY_ACCOUNT", None),
            ("DEFERRED_PAYMENT", None), ("DEFERRED_X", None), ("DEBIT_CREDIT", None), (None, None),
        ],
        "payment_methods string, penalty_start_date date",
    ).withColumn("creation_date", F.lit(d("2026-10-05")))
    got = [r[0] for r in df.select(initiatives.mix_class(IMPACT)).collect()]
    assert got == [fixed.LINK_NEW, fixed.LINK_OLD, fixed.LINK_OLD, "Cuenta corriente", "Pago diferido", "Gestor de pagos", "Débito", "Otros"]


def test_revenue_rules_in_order(spark):
    df = spark.createDataFrame(
        [
            ("BR", fixed.AFFILIATES, "Hoteles"), ("BR", fixed.AFFILIATES, "Vuelos"), ("BR", "x", "Hoteles"), ("BR", fixed.AFFILIATES, None),
            ("MX", "x", "y"), ("CO", "x", "y"), ("CL", "x", "y"), ("US", "x", "y"), ("PA", "x", "y"), ("AR", "x", "y"),
        ],
        "country_code string, parent_channel string, product string",
    ).withColumns({"net_revenues_usd": F.lit(100.0), "affiliates_usd": F.lit(10.0)})
    got = [float(r[0]) for r in df.select(first_half.adjusted_revenue()).collect()]
    assert got == [82.8, 92.0, 97.0, 97.0, 85.0, 84.0, 92.0, 80.0, 80.0, 97.0]


def test_partner_override_comes_before_the_country(spark):
    df = spark.createDataFrame([("AP12142", "MX"), ("AP1", "MX"), ("AP1", "US"), (None, "PE"), ("AP1", None)], "partner_id string, country_code string")
    assert [r[0] for r in df.select(first_half.revenue_country()).collect()] == ["O", "MX", "O", "PE", "O"]
