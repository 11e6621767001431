from dataclasses import replace
from decimal import Decimal

import pytest

from checks import roles as R
from kpiloom.plans import first_half, initiatives
from kpiloom.sources.tables import SCHEMAS, Tables
from tests.conftest import d, rows


def tables(spark, **data):
    return Tables(lambda role: spark.createDataFrame(data.get(role, []), SCHEMAS[role]))


def sale(tx, status="Confirmado", gb="10", agency="ag1", partner="AP1", country="AR", channel="web-gold", day="1999-02-01", product="Hoteles", pid=None, buy="Hoteles", name="x"):
    return (tx, tx, pid or f"P{tx}", partner, agency, name, country, channel, "Agencias afiliadas", product, buy, "line-O", status, d(day), d(day), day[:7], Decimal(gb))


def reservation(tx, status="ACTIVE", channel="web-gold", last=True, flow="FLIGHT", day="1999-02-01"):
    return (str(tx), f"R{tx}", status, "AR", channel, last, d(day), flow)


def test_reservation_with_two_sale_statuses_counts_under_both(spark):
    from datetime import datetime

    t = tables(
        spark,
        sales=[sale(1, "Cancelado", "5"), sale(1, "Confirmado", "7"), sale(1, "Confirmado", "1")],
        reservations=[reservation(1), reservation(2), reservation(3, last=False), reservation(4, channel="other")],
        cancellations=[("R1", "TIMEOUT_CLIENT")],
        deferred=[(f"R{k}", "PROMISE-B2B", datetime(1999, 3, 9)) for k in (1, 2, 3, 4)] + [("R2", "OTHER", datetime(1999, 3, 9)), ("R2", "PROMISE-B2B", None)],
    )
    assert rows(first_half.kr21(t, R.FIRST)) == [(d("1999-03-01"), "ACTIVE", 2, 8.0), (d("1999-03-01"), "Time_out_client", 1, 5.0)]


def test_side_rows_multiply_the_value_as_a_join_does(spark):
    from datetime import datetime

    t = tables(
        spark, sales=[sale(1, gb="5"), sale(1, gb="6")], reservations=[reservation(1)], cancellations=[("R1", "CLIENT"), ("R1", "CLIENT")],
        deferred=[("R1", "PROMISE-B2B", datetime(1999, 3, 9)), ("R1", "PROMISE-B2B", datetime(1999, 3, 20))],
    )
    assert rows(first_half.kr21(t, R.FIRST)) == [(d("1999-03-01"), "ACTIVE", 1, 44.0)]


def revenue_tables(spark):
    sheet = ("15/1/1999", "1", "Hotels", "Argentina", "B2B-MIN", "50")
    budget = ("15-1-1999", "1", "Hotels", "Argentina", "B2B-MIN", "60")
    services = ("15/1/1999", "1", "Dest. Serv.", "Argentina", "B2B-MIN", "7")
    return tables(
        spark, sales=[sale(1, day="1999-01-10"), sale(2, day="1999-01-10", buy="Traslados")],
        profit=[(k, k, Decimal(100), Decimal(0), "B2B", "1999-01") for k in (1, 2)],
        transactions=[(str(k), "AP1", "ag1", "x", "web-gold", "Agencias afiliadas", "B2B", d("1999-01-01"), d("1999-01-10"), None, None) for k in (1, 2)],
        forecast=[sheet, services], budget=[budget],
    )


def test_both_plans_count_the_actual_twice(spark):
    t = revenue_tables(spark)
    assert rows(first_half.kr31(t, R.FIRST)) == [("1999-01", 97.0 * 3, 117.0)]
    assert rows(first_half.kr31(t, R.FIRST, ("FCST",))) == [("1999-01", 97.0 * 2, 57.0)]


def test_services_meet_their_plan_when_aligned(spark):
    t = revenue_tables(spark)
    both = first_half.kr31(t, R.FIRST, ("FCST",), align_services=True)
    assert rows(both) == [("1999-01", 194.0, 57.0)]


def test_full_date_as_period_bound_drops_the_first_month(spark):
    t = revenue_tables(spark)
    strict = replace(R.FIRST, revenue_from=d("1999-01-01"), revenue_period_from="1999-01-01")
    assert rows(first_half.kr31_sem(t, replace(R.FIRST, revenue_from=d("1999-01-01")))) != []
    assert rows(first_half.kr31_sem(t, strict)) == []


def test_reservations_without_status_do_not_count_for_the_uplift(spark):
    t = tables(
        spark, sales=[sale(k, day="1999-01-05") for k in (1, 2, 3)] + [sale(k, day="1999-02-05") for k in range(4, 8)] + [sale(4, day="1999-02-05")],
        reservations=[reservation(1), reservation(2, status=None), reservation(3, status="TO_CANCEL")] + [reservation(k) for k in range(4, 8)],
    )
    got = {r.mes_evaluacion: r for r in first_half.kr33(t, R.FIRST).collect()}
    assert got[199902].agencias_1_3_previo == 1 and got[199902].agencias_aumentaron == 1


def test_quotes_need_an_agency(spark):
    from datetime import datetime

    t = tables(
        spark, sales=[sale(1, agency="AG1"), sale(2, "Activo", agency="ag2")],
        quotations=[(datetime(1999, 2, 3), a, "web-gold") for a in ("ag1", "AG1", "ag2", "", None)] + [(datetime(1999, 2, 3), "ag3", "other")],
    )
    assert rows(first_half.kr32(t, R.FIRST)) == [(d("1999-02-01"), 2, 1, 3, 50.0)]


def test_repeaters_of_the_total_span_countries(spark):
    day = "1999-05-10"
    t = tables(
        spark, sales=[sale(1, country="AR", day=day), sale(2, country="BR", day=day), sale(3, "Cancelado", country="AR", day=day), sale(4, country="AR", day=day, pid="other")],
        products=[(f"P{k}", "REMOTE", False, d("1999-06-01"), None) for k in (1, 2, 3)] + [("other", "CASH", False, None, None)],
    )
    got = {r.c: r for r in initiatives.ldp_country(t, R.IMPACT).collect()}
    assert (got["AR"].nl, got["AR"].rep, got["AR"].nc, got["BR"].rep) == (1, 0, 1, 0)
    assert (got["ALL"].nl, got["ALL"].ag, got["ALL"].rep) == (2, 1, 1)
    assert (got["TOT"].nl, got["TOT"].rep, got["TOT"].ld) == (3, 0, "")


def test_totals_stay_on_empty_input(spark):
    got = {r.c: (r.nl, r.gl, r.rep) for r in initiatives.ldp_country(tables(spark), R.IMPACT).collect()}
    assert got == {"ALL": (0, None, 0), "TOT": (0, None, 0)}
    assert [tuple(r) for r in initiatives.wallet_agencies(tables(spark), R.IMPACT).select("c", "agw", "agt").collect()] == [("ALL", 0, 0)]


@pytest.mark.parametrize("name", ["", None])
def test_agencies_without_name_stay(spark, name):
    t = tables(spark, sales=[sale(1, day="1999-05-10", name=name), sale(2, day="1999-05-10", name="TEST 1")], products=[("P1", "REMOTE", False, d("1999-06-01"), None)])
    assert [r.n for r in initiatives.ldp_top(t, R.IMPACT).collect()] == [1]


def test_wallet_needs_a_second_method(spark):
    from datetime import datetime

    methods = {1: ("DWALLET", "CARD"), 2: ("DWALLET", "DWALLET"), 3: ("CARD", "PSE"), 4: ("PSE", "DWALLET")}
    pairs = [(k, i, m) for k, ms in methods.items() for i, m in enumerate(ms)]
    t = tables(
        spark, reservations=[reservation(k) for k in methods], schedules=[(f"S{k}", str(k), "CLOSED", datetime(1999, 5, 1)) for k in methods],
        intentions=[(f"I{k}{i}", f"S{k}", "COLLECTED" if (k, i) != (4, 0) else "PENDING") for k, i, _ in pairs],
        scheduled_collections=[(f"I{k}{i}", f"C{k}{i}") for k, i, _ in pairs], collections=[(f"C{k}{i}", f"R{k}", m) for k, i, m in pairs],
    )
    assert rows(initiatives.wallet_methods(t, R.IMPACT, d("1999-04-26"), d("1999-04-27"))) == [("1", "CARD", "CARD")]
    assert rows(initiatives.wallet_methods(t, R.IMPACT, d("1999-04-26"), d("1999-05-02"))) == [("1", "CARD", None)]
    assert rows(initiatives.wallet_methods(t, R.IMPACT, d("1999-05-02"), d("1999-05-03"))) == []
