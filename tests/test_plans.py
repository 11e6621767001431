"""Properties of the physical plans that decide how the jobs scale."""

from decimal import Decimal

import pytest

from checks import roles as R
from kpiloom.operators import funnel
from kpiloom.plans import first_half, second_half
from kpiloom.sources.tables import SCHEMAS, Tables, open_tables
from tests.conftest import d, plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def partitioned(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sales"))
    rows = [
        (k, k, f"P{k}", "AP1", "ag1", "x", "AR", "web-gold", "Agencias afiliadas", "Hoteles", "Hoteles", "line-O", "Confirmado", d(day), d(day), day[:7], Decimal(10))
        for k, day in enumerate(["1997-12-05", "1998-01-05", "1998-02-05", "1999-02-05"])
    ]
    spark.createDataFrame(rows, SCHEMAS["sales"]).write.mode("overwrite").partitionBy("partition_period").parquet(path)
    products = str(tmp_path_factory.mktemp("products"))
    spark.createDataFrame([("P1", "WALLET", False, None, None), ("P2", "CASH", False, None, None)], SCHEMAS["products"]).write.mode("overwrite").parquet(products)
    return open_tables(spark, {"sales": path, "products": products})


def test_periods_prune_partitions_and_columns(partitioned):
    df = second_half.kr11(partitioned, R.SECOND)
    got = {r.mes: (r.gb_metodo_propio, r.gb_total_usd) for r in df.collect()}
    assert got["1998-01"] == (10.0, 10.0) and got["1998-02"] == (0.0, 10.0)
    text = plan(df)
    assert "PartitionFilters: [isnotnull(partition_period" in text and ">= 1998-01)]" in text
    scans = [line for line in text.splitlines() if line.startswith("ReadSchema: struct<") and "gb:" in line]
    assert scans and all("agency_name" not in line and "buy_type_code" not in line for line in scans)


def test_filters_reach_the_scan(spark):
    text = plan(second_half.kr21(R.roles(spark, SF), R.SECOND))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in text and "LessThan(o_orderdate,1998-05-01" in text


def test_only_the_needed_event_fields_are_read(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([("2024-01-05T00:00:00", ("p", "filter", "1", ("n", ["v"])))], SCHEMAS["array_events"]).write.parquet(path)
    text = plan(funnel.clicks_from_label(spark.createDataFrame([], SCHEMAS["label_events"]), "label", R.USAGE_FROM, R.USAGE_TO))
    assert text
    text = plan(funnel.clicks_from_array(spark.read.parquet(path), "array", R.USAGE_FROM, R.USAGE_TO))
    assert "GreaterThanOrEqual(datetime,2024-01-05)" in text


def test_cumulative_counts_shuffle_entities_once(spark):
    df = first_half.kr22_sem_cum(R.roles(spark, SF), R.FIRST)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 1


def test_quotes_and_sales_meet_in_one_grouping(spark):
    text = plan(first_half.kr32(R.roles(spark, SF), R.FIRST), "simple")
    assert text.count("Join") == text.count("BroadcastHashJoin") and "Union" in text


def test_tables_open_once(spark):
    opened = []
    t = Tables(lambda name: opened.append(name) or spark.range(1))
    t.sales, t.sales
    assert opened == ["sales"]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_page_views_are_read_twice_at_most(spark):
    from checks.board_queries import usage

    text = final_plan(usage(R.roles(spark, SF), R.CLICKS))
    views = [line for line in text.splitlines() if "FileScan" in line]
    # the four event tables; the page views for all visits, and for the sources that have clicks
    assert len(views) <= 6 and text.count("ReusedExchange") >= 1


def test_bookings_are_read_from_the_first_month_that_counts(partitioned, spark):
    tables = Tables(lambda role: getattr(partitioned, role) if role == "sales" else getattr(R.roles(spark, SF), role))
    text = plan(first_half.kr33(tables, R.FIRST))
    assert ">= 1997-01)]" in text and text.count("Join type: LeftSemi") == 1


def test_only_the_sales_of_promised_reservations_are_grouped(spark):
    text = plan(first_half.kr21(R.roles(spark, SF), R.FIRST), "simple")
    grouped = [k for k, line in enumerate(text.splitlines()) if "keys=[_tc" in line]
    assert grouped and any("LeftSemi" in line for line in text.splitlines()[grouped[-1]:])


def test_a_board_computes_each_metric_once(spark, tmp_path):
    from kpiloom.plans import boards, registry

    calls = []

    def metric(key, rows):
        return lambda t, s: calls.append(key) or spark.createDataFrame(rows, "c string, n long")

    kept = registry.stored({k: metric(k, [("AR", 1)]) for k in "xyz"}, ["x", "y", "x"], None, None, str(tmp_path))
    assert sorted(calls) == ["x", "y"] and kept["x"].union(kept["y"]).count() == 2
    stored = {k: spark.createDataFrame([], s) for k, s in (
        ("kr21_sem", "semana_inicio date, pct_timeout_client double"), ("kr22_sem", "semana_inicio date, cant_agencias_unicas long"),
        ("kr31_sem", "semana_inicio date, net_revenue_real double"), ("kr32_sem", "semana_inicio date, pct_activacion_comercial double"),
    )}
    assert boards.weekly_series(stored).count() == 0


def test_a_bad_amount_or_date_fails_and_is_not_lost(spark):
    from pyspark.errors import PySparkException

    from kpiloom.sources.tables import conform, rejected_keys

    schema = SCHEMAS["forecast"]
    good, amount, day = ("5/3/2026", "3", "Hotels", "Mexico", "B2B-MIN", "10"), ("5/3/2026", "3", "Hotels", "Mexico", "B2B-MIN", "1,234.5"), ("5/3/x", "3", "Hotels", "Mexico", "B2B-MIN", "1")
    assert first_half.sheet_revenue(spark.createDataFrame([good], schema), "/", "F").first().net_revenue_target == 10
    for bad in (amount, day):
        with pytest.raises(PySparkException):
            first_half.sheet_revenue(spark.createDataFrame([good, bad], schema), "/", "F").collect()
    text = spark.createDataFrame([("7", "12", "x1", "B2B", "1.5", "2026-01"), ("8", "q", "1", "B2B", "2", "2026-01")],
                                 "product_id string, transaction_code string, net_revenues_usd string, line_of_business string, affiliates_usd string, date_reservation_year_month string")
    assert [r.product_id for r in rejected_keys(text, "profit").collect()] == ["8"]
    with pytest.raises(PySparkException):
        conform(text, "profit").collect()


@pytest.mark.parametrize("name, label", [("ldp_totals", "ALL"), ("ldp_country", "ALL"), ("wallet_agencies", "ALL"), ("pp_a", "TT")])
def test_totals_come_from_rows_per_entity(spark, name, label):
    from kpiloom.plans import initiatives

    df = getattr(initiatives, name)(R.roles(spark, SF), R.IMPACT)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    doubled = [k for k, line in enumerate(lines) if "Generate explode" in line and label in line]
    assert doubled
    for k in doubled:  # below it, that is deeper and later, rows have been grouped
        depth = len(lines[k]) - len(lines[k].lstrip(" :+-"))
        below = []
        for line in lines[k + 1 :]:
            if len(line) - len(line.lstrip(" :+-")) <= depth:
                break
            below.append(line)
        assert any("Aggregate" in line for line in below)
    assert final_plan(df).count("ReusedExchange") >= 1


def test_places_need_no_single_task(spark):
    from kpiloom.plans import registry
    from pyspark.sql import functions as F

    rows = spark.range(100).select(F.lit("p").alias("product"), F.lit("w").alias("week_start"), F.lit("c").alias("country"), "id", F.col("id").alias("clicks"), F.col("id").cast("string").alias("filter_name"))
    assert "SinglePartition" not in final_plan(registry.numbered("filter_usage", rows))


FAMILIES = {
    "wallet": (("wallet_daily", "wallet_agencies", "wallet_mix"), ("schedules", "intentions", "scheduled_collections", "collections", "reservations", "payments", "transactions")),
    "promises": (("kr21", "kr21_sem", "kr21_sem_cum"), ("deferred", "cancellations", "reservations", "sales")),
    "uplift": (("kr33", "kr33_sem", "kr33_sem_cum"), ("sales", "reservations")),
}


@pytest.mark.parametrize("family", FAMILIES)
def test_a_family_reads_its_facts_once(spark, family, tmp_path, monkeypatch):
    """Of metrics that share a base only the base reads facts; results equal those of each metric alone."""
    from kpiloom.plans import initiatives, registry
    from tests.conftest import rows

    keys, facts = FAMILIES[family]
    metrics, settings = (registry.INITIATIVES, R.IMPACT) if family == "wallet" else (registry.FIRST_HALF, R.FIRST)
    opened = []
    tables = R.roles(spark, SF)

    class EachTime:  # notes a role whenever it is asked for
        def __getattr__(self, role):
            opened.append(role)
            return getattr(tables, role)

    kept = registry.stored(metrics, keys, EachTime(), settings, str(tmp_path))
    assert sorted(r for r in opened if r in facts) == sorted(facts)
    for key in keys:
        assert rows(kept[key]) == rows(metrics[key](tables, settings))


# family: (metrics, their settings, keys, how often each fact is read)
SHARED = {
    # the agencies of earlier promises are of other days; two metrics look at the booked product
    "promise board": (
        "INITIATIVES", R.IMPACT, ("pp_a", "pp_m", "pp_x", "pp_ctl", "pp_ag", "pp_agw"),
        {"sales": 2, "reservations": 2, "deferred": 2, "products": 2},
    ),
    "promises by week": ("FIRST_HALF", R.FIRST, ("kr21_sem", "kr21_sem_cum"), {"deferred": 1, "cancellations": 1, "sales": 1}),
    "revenue by week": ("FIRST_HALF", R.FIRST, ("kr31_sem", "kr31_sem_cum"), {"sales": 1, "profit": 1, "transactions": 1}),
    "requests by week": ("FIRST_HALF", R.FIRST, ("kr22_sem", "kr22_sem_cum"), {"requests": 1, "transactions": 1}),
    "revenue": (
        "FIRST_HALF", R.FIRST, ("kr31", "kr31_sem", "kr31_sem_cum"), {"sales": 1, "profit": 1, "transactions": 1, "forecast": 1},
    ),
    "activation by week": ("FIRST_HALF", R.FIRST, ("kr32_sem", "kr32_sem_cum"), {"sales": 1, "quotations": 1}),
}


@pytest.mark.parametrize("family", SHARED)
def test_a_board_reads_the_facts_of_a_family_once(spark, family, tmp_path):
    from collections import Counter

    from kpiloom.plans import registry
    from tests.conftest import rows

    group, settings, keys, facts = SHARED[family]
    metrics, tables, opened = getattr(registry, group), R.roles(spark, SF), []

    class EachTime:  # notes a role whenever it is asked for
        def __getattr__(self, role):
            opened.append(role)
            return getattr(tables, role)

    kept = registry.stored(metrics, keys, EachTime(), settings, str(tmp_path))
    assert {r: n for r, n in Counter(opened).items() if r in facts} == facts
    for key in keys:
        assert rows(kept[key]) == rows(metrics[key](tables, settings))


def test_a_base_that_one_metric_reads_often_is_stored(spark):
    from kpiloom.plans import registry
    from tests.conftest import rows

    shared = registry.Shared(registry.FIRST_HALF, ["kr33_sem_cum"], R.roles(spark, SF), R.FIRST)
    out = shared.rows("kr33_sem_cum")
    assert list(shared.stored) == [first_half.channel_bookings]
    assert "lineitem" not in plan(out)
    assert rows(out) == rows(first_half.kr33_sem_cum(R.roles(spark, SF), R.FIRST))
    both = registry.Shared(registry.FIRST_HALF, ["kr33", "kr33_sem_cum"], R.roles(spark, SF), R.FIRST)
    assert set(both.bases.values()) == {first_half.booking_base}
    for keys, base in (
        (("kr21_sem", "kr21_sem_cum"), first_half.promise_weeks), (("kr21", "kr21_sem"), first_half.promise_base),
        (("kr31_sem", "kr31_sem_cum"), first_half.revenue_weeks), (("kr31", "kr31_sem_cum"), first_half.revenue_base),
    ):
        assert set(registry.Shared(registry.FIRST_HALF, keys, None, R.FIRST).bases.values()) == {base}
    keys = ["kr32_sem", "kr32_sem_cum", "kr32", "kr33_sem_cum"]
    waiting = registry.Shared(registry.FIRST_HALF, keys, R.roles(spark, SF), R.FIRST)
    assert waiting.spread(keys) == ["kr32_sem", "kr32", "kr33_sem_cum", "kr32_sem_cum"]
