"""The metrics' input roles, derived by Spark from the given tables.

Codes and texts come from the tables' own columns; missing, empty, repeated and odd values are mixed in by key so that
the outer joins and guards have work to do. ``checks.role_sql`` states the same derivation in DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from kpiloom.functions import fixed
from kpiloom.plans.settings import Settings
from kpiloom.sources.tables import Tables

COUNTRIES = ("MX", "AR", "CL", "BR", "CO", "PE", "US", "EC", "UY", "PA")
VISIT_COUNTRIES = ("BR", "MX", "CO", "AR", "CL", "PE", "UY", "EC")
CHANNELS = ("web-gold", "web-silver", "web-classic", "web-platinum")
PRODUCTS = ("Hoteles", "Vuelos", "Autos", "Traslados", "Asistencia al viajero", "Excursiones")
BUY_TYPES = ("Bundles", "Carrito", "Actividades", "Hoteles", "Vuelos", "Autos")
SHEET_PRODUCTS = (*fixed.SHEET_PRODUCTS, "Unknown")
SHEET_COUNTRIES = ("Mexico", "Argentina", "Chile", "Brasil", "Colombia", "Peru", "USA", "Ecuador", "Uruguay", "Panama")
TRAFFIC_PRODUCTS = tuple(fixed.USAGE_PRODUCTS)
MAX_DAY = date(2000, 6, 30)


def pick(values, index: str) -> str:
    """SQL: the member of a literal list at a 0-based index."""
    return f"array({', '.join(repr(v) for v in values)})[cast({index} as int)]"


CHANNEL = (
    "case c_mktsegment when 'BUILDING' then 'web-gold' when 'HOUSEHOLD' then 'web-silver' "
    "when 'MACHINERY' then 'web-classic' when 'FURNITURE' then 'web-platinum' else 'office' end"
)
COUNTRY = pick(COUNTRIES, "c_nationkey % 10")
NAME = "case when o_custkey % 29 = 0 then 'Contest Travel' when o_custkey % 31 = 0 then null else c_name end"
PARENT = f"case when o_custkey % 8 = 0 then 'Otros' else '{fixed.AFFILIATES}' end"
STATUS = "case o_orderstatus when 'F' then 'Confirmado' when 'O' then 'Activo' else 'Cancelado' end"
K = "cast(regexp_extract(props, '[0-9]+', 0) as int)"
PAGEVIEW = "concat('p', user_id, '-', dayofyear(ts) div 2)"
STAMP = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"


def _reader(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    opened: dict[str, DataFrame] = {}

    def read(name: str) -> DataFrame:
        if name not in opened:
            opened[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return opened[name]

    return read


def _sales(read):
    lines = read("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_linestatus", "l_shipdate"
    )
    orders, customer = read("orders"), read("customer")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(customer, orders.o_custkey == customer.c_custkey)
    return rows.selectExpr(
        "l_orderkey as transaction_code", "l_orderkey * 8 + l_linenumber as product_id",
        "case when l_orderkey % 23 = 0 then null else concat('P', l_orderkey) end as origin_product_id",
        "concat('AG', o_custkey div 7) as partner_id", "concat('ag', o_custkey div 7) as agency_code",
        f"{NAME} as agency_name", f"{COUNTRY} as country_code", f"{CHANNEL} as channel", f"{PARENT} as parent_channel",
        f"{pick(PRODUCTS, 'l_partkey % 6')} as product", f"{pick(BUY_TYPES, '(l_partkey div 6) % 6')} as buy_type_code",
        "case when l_suppkey % 11 = 0 then 'line-X' else concat('line-', l_linestatus) end as lob_gestion",
        f"{STATUS} as transaction_status", "to_date(o_orderdate) as creation_date", "to_date(l_shipdate) as gestion_date",
        "date_format(o_orderdate, 'yyyy-MM') as partition_period", "cast(l_extendedprice as decimal(18,2)) as gb",
    )


def _order_customer(read):
    orders, customer = read("orders"), read("customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


def _reservations(read):
    return _order_customer(read).selectExpr(
        "cast(o_orderkey as string) as id", "concat('R', o_orderkey) as oid",
        "case when o_orderkey % 7 = 0 then 'TO_CANCEL' when o_orderkey % 11 = 0 then null "
        "when o_orderstatus = 'F' then 'CONFIRMED' when o_orderstatus = 'O' then 'ACTIVE' else 'CANCELLED' end as status",
        f"{COUNTRY} as country_code", f"{CHANNEL} as channel", "o_orderkey % 13 <> 0 as last_version",
        "to_date(o_orderdate) as date", f"{pick(('FLIGHT_HOTEL', 'FLIGHT', 'CART'), 'o_orderkey % 3')} as shopping_flow_source",
    )


def _cancellations(read):
    rows = read("orders").where("o_orderstatus = 'P'")
    columns = ["concat('R', o_orderkey) as reservation_id", "if(o_orderkey % 5 < 3, 'TIMEOUT_CLIENT', 'CLIENT') as type"]
    return rows.selectExpr(*columns).unionByName(rows.where("o_orderkey % 10 = 0").selectExpr(*columns))


def _deferred(read):
    rows = read("orders")
    deadline = "case when o_orderkey % 33 = 0 then null else o_orderdate + make_dt_interval(cast(o_custkey % 40 + {0} as int)) end as deadline"
    columns = ["concat('R', o_orderkey) as reservation_id", "if(o_orderkey % 6 = 3, 'PROMISE-B2B', if(o_orderkey % 3 = 0, 'OTHER', 'NONE')) as reason"]
    return rows.selectExpr(*columns, deadline.format(0)).unionByName(
        rows.where("o_orderkey % 15 = 0").selectExpr(*columns, deadline.format(35))
    )


def _requests(read):
    return read("lineitem").selectExpr(
        "concat(if(l_linenumber % 2 = 0, 'ext.', ''), 'u', l_suppkey) as created_user",
        "date_format(l_shipdate, 'yyyy-MM') as creation_yearmonth", "to_date(l_shipdate) as creation_date",
        "cast(l_orderkey as string) as transaction_code",
    )


def _transactions(read):
    return _order_customer(read).selectExpr(
        "cast(o_orderkey as string) as transaction_code",
        "concat(if(o_custkey % 4 = 0, 'WLAG', 'AG'), o_custkey div 40) as partner_data_id",
        "concat('ag', o_custkey div 7) as agency_code", f"{NAME} as agency_fantasy_name", f"{CHANNEL} as channel",
        f"{PARENT} as parent_channel", "if(o_custkey % 9 = 0, 'B2C', 'B2B') as line_of_business",
        "case when o_orderkey % 101 = 0 then null else trunc(o_orderdate, 'month') end as reservation_year_month",
        "to_date(o_orderdate) as reservation_date",
        "case when o_orderstatus <> 'O' then o_orderdate + make_dt_interval(cast(o_orderkey % 3 as int)) end as confirmation_date",
        "case when o_orderstatus = 'P' then o_orderdate + make_dt_interval(cast(o_orderkey % 23 as int)) end as cancelation_date",
    )


def _payroll(read):
    return read("supplier").selectExpr(
        "concat(if(s_suppkey % 2 = 0, 'ext.', ''), if(s_suppkey % 3 = 2, 'left', 'u'), s_suppkey) as ad_username"
    )


def _sheet(read, fecha: str, other: str):
    """Sheet lines; those for which ``other`` holds are of another line of business."""
    return _order_customer(read).selectExpr(
        f"{fecha} as fecha", "cast(month(o_orderdate) as string) as no_mes_proyectado",
        f"{pick(SHEET_PRODUCTS, 'o_orderkey % 9')} as producto", f"{pick(SHEET_COUNTRIES, 'c_nationkey % 10')} as pais",
        f"if(o_custkey % 6 = 0 or {other}, 'OTHER', 'B2B-MIN') as lob_canal",
        "cast(cast(o_totalprice as decimal(15,2)) as string) as net_revenue",
    )


def _forecast(read):
    return _sheet(read, "concat(day(o_orderdate), '/', month(o_orderdate), '/', year(o_orderdate))", "false")


def _budget(read):
    year = "if(year(o_orderdate) >= 2000, lpad(cast(year(o_orderdate) - 2000 as string), 2, '0'), cast(year(o_orderdate) as string))"
    return _sheet(read, f"concat(day(o_orderdate), '-', month(o_orderdate), '-', {year})", "o_orderkey % 2 <> 0")


def _side_table(product_id: str):
    return lambda read: read("lineitem").selectExpr(f"cast({product_id} as string) as product_id")


def _profit(read):
    net = "cast(l_extendedprice as decimal(15,2))"
    return read("lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber as product_id", "l_orderkey as transaction_code", f"{net} as net_revenues_usd",
        f"{net} * cast(l_discount as decimal(4,2)) as affiliates_usd",
        "if(l_suppkey % 10 = 0, 'OTHER', 'B2B') as line_of_business",
        "date_format(l_shipdate, 'yyyy-MM') as date_reservation_year_month",
    )


def _quotations(read):
    return read("orders").selectExpr(
        "o_orderdate as created_at",
        "case when o_custkey % 37 = 0 then '' when o_custkey % 41 = 0 then null "
        "else concat(if(o_orderkey % 2 = 0, 'ag', 'AG'), o_custkey div 7) end as agency_code",
        f"if(o_orderkey % 3 = 0, 'office', {pick((*CHANNELS, 'office'), 'o_custkey % 5')}) as channel_code",
    )


def _products(read):
    rare = pick(("DEFERRED_PAYMENT", "DEFERRED_X", "CASH", "DEBIT_CARD"), "o_orderkey % 4")
    return read("orders").selectExpr(
        "concat(if(o_orderkey % 19 = 0, 'Q', 'P'), o_orderkey) as transaction_id",
        "case o_orderpriority when '1-URGENT' then 'REMOTE' when '2-HIGH' then 'CREDIT_CARD' when '3-MEDIUM' then 'WALLET' "
        f"when '4-NOT SPECIFIED' then {rare} else (case o_orderkey % 4 when 0 then 'AGENCY_ACCOUNT' "
        "when 1 then 'CURRENT_ACCOUNT' when 3 then 'OTHER' end) end as payment_methods",
        "case when o_orderkey % 5 = 0 then null else o_orderkey % 5 < 3 end as refundable",
        "case when o_orderkey % 17 = 0 then null else date_add(to_date(o_orderdate), cast(o_custkey % 30 - 10 as int)) end as penalty_start_date",
        "case o_orderkey % 5 when 0 then 'AGENCY_CANCELED' when 1 then 'TIMEOUT_48' when 2 then 'BOOKING_ERROR' "
        "when 3 then 'OTHER' end as cancellation_reason",
    )


def _schedules(read):
    return read("orders").selectExpr(
        "concat('S', o_orderkey) as id", "cast(o_orderkey as string) as transaction_id",
        "if(o_orderkey % 4 = 0, 'OPEN', 'CLOSED') as status", "o_orderdate as created_at",
    )


def _intentions(read):
    return read("lineitem").selectExpr(
        "concat('I', l_orderkey, '-', l_linenumber) as id", "concat('S', l_orderkey) as payment_schedule_id",
        "if(l_linestatus = 'O' and l_suppkey % 5 = 4, 'PENDING', 'COLLECTED') as status",
    )


def _scheduled_collections(read):
    return read("lineitem").selectExpr(
        "concat('I', l_orderkey, '-', l_linenumber) as payment_intention_id",
        "concat('C', l_orderkey, '-', l_linenumber) as collectionId",
    ).distinct()


def _collections(read):
    return read("lineitem").selectExpr(
        "concat('C', l_orderkey, '-', l_linenumber) as cobra_id", "concat('R', l_orderkey) as reservation_id",
        "case l_returnflag when 'R' then 'DWALLET' when 'A' then 'CARD' else 'PSE' end as channel_id",
    )


def _payments(read):
    return _order_customer(read).selectExpr(
        "cast(o_orderkey as string) as transaction_code", f"{COUNTRY} as country_code",
        "to_date(o_orderdate) as reservation_date", "trunc(o_orderdate, 'month') as reservation_year_month",
        "cast(o_totalprice as decimal(18,2)) as gross_booking", "if(o_orderstatus = 'P', 0, 1) as is_confirmed_flg",
    )


def _traffic(read):
    return read("events").selectExpr(
        "concat('v', user_id, '-', dayofyear(ts) div 4) as visit", f"{PAGEVIEW} as pageview_id",
        f"{pick(TRAFFIC_PRODUCTS, f'{K} % 6')} as product",
        "case event_type when 'view' then 'SEARCH' when 'purchase' then 'THANKS' else 'HOME' end as flow",
        f"{pick(VISIT_COUNTRIES, 'user_id % 8')} as country", f"{pick((*CHANNELS, 'office'), 'user_id % 5')} as channel",
        "date_format(ts, 'yyyy-MM-dd') as date", "if(event_id % 17 = 0, 0, 1) as ispageview",
        "if(event_id % 13 = 0, 1, 0) as flg_detalle_cp", "if(user_id % 19 = 0, 1, 0) as is_bot",
    )


CLICK = "event_type in ('click', 'error')"


def _map_events(own: str):
    """Every event; those that are no click of this source carry no filter value."""
    def build(read):
        return read("events").selectExpr(
            f"{STAMP} as datetime",
            f"named_struct('pageview_id', {PAGEVIEW}, 'filters', if({CLICK} and {own}, map('price', array_repeat('v', {K} % 3), "
            f"'stars', array_repeat('5', {K} % 2), concat('f', {K} % 5), array('x')), map('price', cast(array() as array<string>)))) as event",
        )

    return build


def _array_events(read):
    return read("events").selectExpr(
        f"{STAMP} as datetime",
        f"named_struct('pageview_id', {PAGEVIEW}, 'type', if({K} % 7 = 0 or not ({CLICK} and event_id % 4 < 2), 'sort', 'filter'), 'selected', "
        f"if({K} % 5 = 0, '0', '1'), 'event', named_struct('name', concat('n', {K} % 4), 'values', "
        f"array_repeat('v', {K} % 3))) as event",
    )


def _label_events(read):
    label = pick(("sorting", "ai-search", "zone", "length", "price"), f"{K} % 5")
    return read("events").selectExpr(
        f"{STAMP} as datetime",
        f"named_struct('pageview_id', {PAGEVIEW}, 'action', if({K} % 8 = 0 or not ({CLICK} and event_id % 4 >= 2), 'open', 'apply'), 'label', {label}, "
        f"'data', map(if({K} % 6 = 0, 'other', 'filter'), 'v')) as event",
    )


def _flight_events(read):
    code = pick((fixed.GRID_SHOW, fixed.GRID_SHOW, fixed.GRID_TAB, fixed.GRID_CHEAPEST), f"{K} % 4")
    return read("events").selectExpr(
        f"{STAMP} as datetime",
        f"named_struct('pageview_id', {PAGEVIEW}, 'cc', {pick(VISIT_COUNTRIES, 'user_id % 8')}, 'type', "
        f"if(event_type = 'click', 'click', 'show'), 'code', {code}, 'fl', "
        f"if(event_id % 11 = 0 or event_type not in ('view', 'click', 'error'), 'detail', 'search'), "
        f"'ft', {pick(('ONEWAY', 'ROUNDTRIP', 'MULTI'), f'{K} % 3')}) as event",
    )


BUILDERS: dict[str, Callable] = {
    "sales": _sales, "reservations": _reservations, "cancellations": _cancellations, "deferred": _deferred,
    "requests": _requests, "transactions": _transactions, "payroll": _payroll, "forecast": _forecast, "budget": _budget,
    "profit": _profit, "quotations": _quotations, "products": _products, "schedules": _schedules,
    "intentions": _intentions, "scheduled_collections": _scheduled_collections, "collections": _collections,
    "payments": _payments, "traffic": _traffic, "map_a_events": _map_events("event_id % 3 = 0"),
    "map_b_events": _map_events("event_id % 3 = 1"), "array_events": _array_events, "label_events": _label_events,
    "flight_events": _flight_events, "corrections": _side_table("l_orderkey * 8 + l_linenumber"),
    "marketing_funds": _side_table("l_orderkey * 8 + least(l_linenumber, 5)"), "marketing_funds_2": _side_table("l_partkey"),
}


def roles(spark: SparkSession, sf_dir: str) -> Tables:
    read = _reader(spark, sf_dir)
    return Tables(lambda name: BUILDERS[name](read))


MONTHS_99 = tuple(f"1999-{m:02d}" for m in range(1, 13))

FIRST = Settings(
    as_of=MAX_DAY, channels=CHANNELS, wide_channels=(*CHANNELS, "office", "office-label"), channel_prefix="web",
    channel_token="web-", revenue_lines=("line-O", "line-F"), promise_sales_from="1997-01", weeks_from=date(1999, 1, 1),
    weeks_to=date(1999, 12, 31), requests_from="1998-06", request_months=("1998-05", *MONTHS_99),
    request_week_months=MONTHS_99, revenue_from=date(1998, 1, 1), revenue_period_from="1998-01",
    revenue_years=(1998, 1999, 2000), activation_from=date(1998, 1, 1), bookings_after=date(1996, 1, 1),
    uplift_month_from=199701,
)
SECOND = Settings(
    as_of=date(1998, 5, 20), channels=CHANNELS, channel_prefix="web", channel_token="web-", own_methods_from="1998-01",
    own_method_targets=tuple((f"1998-{m:02d}", 1_000_000.0 + 250_000.5 * m) for m in range(1, 8)),
    quoting_from=date(1998, 1, 1), quoting_to=date(1998, 4, 30),
    quoting_targets=tuple((date(1998, m, 1), 5 if m == 3 else 4, 40 + 5 * m) for m in range(1, 7)),
    calendar=(
        ("1998-01", date(1998, 1, 5), date(1998, 2, 1), 4),
        ("1998-02", date(1998, 2, 2), date(1998, 3, 1), 4),
        ("1998-03", date(1998, 3, 2), date(1998, 4, 5), 5),
        ("1998-04", date(1998, 4, 6), date(1998, 5, 3), 4),
        ("1998-05", date(1998, 5, 4), date(1998, 5, 31), 4),
        ("1998-06", date(1998, 6, 1), date(1998, 6, 28), 4),
    ),
    orders_from=date(1998, 1, 5), orders_month_from=date(1998, 1, 1),
    frequent_targets=tuple((f"1998-{m:02d}", 5 if m == 3 else 4, 10 + m) for m in range(1, 7)),
)
IMPACT = Settings(
    as_of=date(1999, 8, 1), channels=CHANNELS, channel_prefix="web",
    link_launches={
        "MX": date(1999, 3, 2), "AR": date(1999, 4, 13), "CL": date(1999, 4, 13), "BR": date(1999, 4, 20),
        "CO": date(1999, 4, 20), "PE": date(1999, 5, 4), "US": date(1999, 6, 8),
    },
    wallet_launches={
        "AR": date(1999, 4, 26), "CL": date(1999, 4, 26), "CO": date(1999, 4, 26), "MX": date(1999, 4, 26),
        "BR": date(1999, 4, 29), "PE": date(1999, 4, 29),
    },
    deferred_launch=date(1999, 4, 19), grid_launch=date(1999, 4, 12), promise_launch=date(1999, 4, 13),
    promise_history_from=date(1997, 1, 1),
)
CLICKS = Settings(
    as_of=date(2024, 1, 31), channels=CHANNELS, grid_launch=date(2024, 1, 5), anchor=date(2024, 1, 5),
)
USAGE_FROM, USAGE_TO = date(2024, 1, 5), date(2024, 1, 25)
