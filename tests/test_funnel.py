import pytest

from kpiloom.operators import funnel
from kpiloom.sources.tables import SCHEMAS
from tests.conftest import d, rows

SINCE, UNTIL = d("2026-08-28"), d("2026-09-10")
CHANNELS = ("web",)


def test_map_shape_needs_a_value(spark):
    events = spark.createDataFrame(
        [
            ("2026-08-28T10:00:00.000", ("p1", {"price": ["1", "2"], "stars": [], "zone": None})), ("2026-08-28T11:00:00.000", ("p1", {"price": ["3"]})),
            ("2026-09-10T23:59:59.999", ("p2", {"price": ["1"]})), ("2026-09-11T00:00:00.000", ("p2", {"late": ["1"]})), ("2026-08-29T00:00:00.000", ("p3", None)),
        ],
        SCHEMAS["map_a_events"],
    )
    assert rows(funnel.clicks_from_map(events, "map_a", SINCE, UNTIL)) == [("map_a", d("2026-08-28"), "p1", "price"), ("map_a", d("2026-09-10"), "p2", "price")]


def test_array_shape(spark):
    day = "2026-08-28T10:00:00.000"
    events = spark.createDataFrame(
        [(day, ("p1", "filter", "1", ("stops", ["0"]))), (day, ("p2", "sort", "1", ("stops", ["0"]))), (day, ("p3", "filter", "0", ("stops", ["0"]))),
         (day, ("p4", "filter", "1", ("stops", []))), (day, ("p5", "filter", "1", ("stops", None)))],
        SCHEMAS["array_events"],
    )
    assert [r.pageview_id for r in funnel.clicks_from_array(events, "array", SINCE, UNTIL).collect()] == ["p1"]


def test_label_shape_without_the_key(spark):
    day = "2026-08-28T10:00:00.000"
    events = spark.createDataFrame(
        [(day, ("p1", "apply", "zone", {"filter": "x"})), (day, ("p2", "apply", "zone", {"other": "x"})), (day, ("p3", "apply", "sorting", {"filter": "x"})),
         (day, ("p4", "open", "zone", {"filter": "x"})), (day, ("p5", "apply", "ai-search", {"filter": "x"})), (day, ("p6", "apply", "zone", None))],
        SCHEMAS["label_events"],
    )
    assert [r.pageview_id for r in funnel.clicks_from_label(events, "label", SINCE, UNTIL).collect()] == ["p1"]


@pytest.fixture(scope="module")
def usage(spark):
    def page(visit, pageview, product="HOTELS", flow="SEARCH", country="AR", day="2026-08-28", channel="web", shown=1, bot=0):
        return (visit, pageview, product, flow, country, channel, day, shown, 0, bot)

    traffic = spark.createDataFrame(
        [
            page("v1", "p1"), page("v1", "p1"), page("v1", "p1b"), page("v2", "p2"), page("v3", "p3", country="UY"), page("v4", "p4", product="FLIGHTS"),
            page("v1", "t1", flow="THANKS"), page("v2", "t2", flow="THANKS", country="BR"), page("v5", "p5", day="2026-09-04"), page("bot", "p6", bot=1),
            page("v7", "p7", channel="other"), page("v8", "p8", shown=0),
        ],
        SCHEMAS["traffic"],
    )
    clicks = spark.createDataFrame(
        [
            ("map_a", d("2026-08-28"), "p1", "price"), ("map_a", d("2026-08-29"), "p1", "price"), ("map_a", d("2026-08-28"), "p1b", "price"),
            ("map_a", d("2026-08-28"), "p2", "price"), ("map_a", d("2026-08-28"), "p2", "stars"), ("map_a", d("2026-08-28"), "p4", "price"),
            ("array", d("2026-08-28"), "p4", "stops"), ("map_a", d("2026-09-05"), "p1", "price"), ("map_a", d("2026-08-28"), "p6", "price"),
        ],
        "source string, d date, pageview_id string, filter_name string",
    )
    return funnel.filter_usage(traffic, clicks, CHANNELS, SINCE, SINCE, UNTIL)


def test_usage_counts_visits_once(usage):
    got = {(r.product, r.week_start.isoformat(), r.country, r.filter_name): (r.visits, r.clicks, r.thanks) for r in usage.collect()}
    assert got == {
        ("Hoteles", "2026-08-28", "AR", "price"): (2, 2, 1),  # v2 bought under another country
        ("Hoteles", "2026-08-28", "AR", "stars"): (2, 1, 0),
        ("Hoteles", "2026-08-28", "OT", None): (1, 0, 0),
        ("Hoteles", "2026-09-04", "AR", None): (1, 0, 0),  # the click of that week belongs to a page view of the week before
        ("Vuelos", "2026-08-28", "AR", "stops"): (1, 1, 0),
    }


def test_totals_add_up_the_countries(usage):
    got = {(r.product, r.week_start.isoformat(), r.filter_name): (r.visits_sum, r.clicks_sum) for r in funnel.usage_totals(usage).collect()}
    assert got["Hoteles", "2026-08-28", "price"] == (3, 2) and got["Hoteles", "2026-09-04", None] == (1, None)


def test_stored_text(usage):
    got = {(r.product, r.country, r.week_start.isoformat()): r.s for r in funnel.packed_usage(usage).collect()}
    assert got["Hoteles", "AR", "2026-08-28"] == "price 2 1;stars 1 0" and got["Hoteles", "OT", "2026-08-28"] == ""


def test_click_through_counts_a_visit_once_per_period(spark):
    pages = [("v1", "a"), ("v1", "b"), ("v2", "c"), ("v1", "a")]
    traffic = spark.createDataFrame([(v, p, "FLIGHTS", "SEARCH", "AR", "web", "2026-11-12", 1, 0, 0) for v, p in pages], SCHEMAS["traffic"])

    def event(day, pageview, kind, code, country="AR", where="search", trip="ONEWAY"):
        return (f"{day}T08:00:00.000", (pageview, country, kind, code, where, trip))

    show, tab, cheap = "calendarPricesMatrix", "calendarPricesMatrixTab", "calendarPricesMatrixCheapestTab"
    events = spark.createDataFrame(
        [
            event("2026-11-12", "a", "show", show), event("2026-11-12", "a", "show", show), event("2026-11-12", "b", "click", tab), event("2026-11-13", "a", "show", show),
            event("2026-11-13", "c", "click", cheap), event("2026-11-12", "c", "show", show, trip="MULTI"), event("2026-11-12", "c", "show", show, where="detail"),
            event("2026-11-11", "c", "show", show), event("2026-11-12", "a", "show", show, country="US"),
        ],
        SCHEMAS["flight_events"],
    )
    got = rows(funnel.click_through(traffic, events, CHANNELS, ("AR", "BR"), d("2026-11-12")).select("grain", "p", "c", "shows", "c_tab", "c_any", "c_cheap"))
    assert got == [
        ("d", "2026-11-12", "AR", 1, 0, 1, 0), ("d", "2026-11-13", "AR", 1, 0, 0, 0), ("m", "2026-11", "AR", 1, 0, 1, 0),
        ("t", "total", "AR", 1, 0, 1, 0), ("w", "2026-11-09", "AR", 1, 0, 1, 0),
    ]
