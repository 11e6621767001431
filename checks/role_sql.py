"""The role derivation of ``checks.roles`` in DuckDB SQL, for the comparison queries."""

from __future__ import annotations

from checks.roles import (
    BUY_TYPES, CHANNELS, COUNTRIES, PRODUCTS, SHEET_COUNTRIES, SHEET_PRODUCTS, TRAFFIC_PRODUCTS, VISIT_COUNTRIES,
)
from kpiloom.functions import fixed


def pick(values, index: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[{index} + 1]"


CHANNEL = (
    "case c_mktsegment when 'BUILDING' then 'web-gold' when 'HOUSEHOLD' then 'web-silver' "
    "when 'MACHINERY' then 'web-classic' when 'FURNITURE' then 'web-platinum' else 'office' end"
)
COUNTRY = pick(COUNTRIES, "c_nationkey % 10")
NAME = "case when o_custkey % 29 = 0 then 'Contest Travel' when o_custkey % 31 = 0 then null else c_name end"
PARENT = f"case when o_custkey % 8 = 0 then 'Otros' else '{fixed.AFFILIATES}' end"
STATUS = "case o_orderstatus when 'F' then 'Confirmado' when 'O' then 'Activo' else 'Cancelado' end"
DAY = "cast(o_orderdate as date)"
SHIP = "cast(l_shipdate as date)"
K = "cast(regexp_extract(props, '[0-9]+') as int)"
PAGEVIEW = "'p' || user_id || '-' || (dayofyear(ts) // 2)"
STAMP = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
ORDERS = "orders join customer on o_custkey = c_custkey"
DEADLINE = "case when o_orderkey % 33 <> 0 then cast(o_orderdate + to_days(cast(o_custkey % 40 + {0} as int)) as timestamp) end as deadline"
PROMISE = "select 'R' || o_orderkey as reservation_id, if(o_orderkey % 6 = 3, 'PROMISE-B2B', if(o_orderkey % 3 = 0, 'OTHER', 'NONE')) as reason, "
CANCEL = "select 'R' || o_orderkey as reservation_id, if(o_orderkey % 5 < 3, 'TIMEOUT_CLIENT', 'CLIENT') as type from orders where o_orderstatus = 'P'"
NET = "cast(l_extendedprice as decimal(15,2))"
SHEET = (
    f"cast(month(o_orderdate) as varchar) as no_mes_proyectado, {pick(SHEET_PRODUCTS, 'o_orderkey % 9')} as producto, "
    f"{pick(SHEET_COUNTRIES, 'c_nationkey % 10')} as pais, if(o_custkey % 6 = 0 or {{other}}, 'OTHER', 'B2B-MIN') as lob_canal, "
    f"cast(cast(o_totalprice as decimal(15,2)) as varchar) as net_revenue from {ORDERS}"
)
CLICK = "from events where event_type in ('click', 'error')"

ROLE_SQL: dict[str, str] = {
    "sales": f"""
select l_orderkey as transaction_code, l_orderkey * 8 + l_linenumber as product_id,
  if(l_orderkey % 23 = 0, null, 'P' || l_orderkey) as origin_product_id, 'AG' || (o_custkey // 7) as partner_id,
  'ag' || (o_custkey // 7) as agency_code, {NAME} as agency_name, {COUNTRY} as country_code, {CHANNEL} as channel,
  {PARENT} as parent_channel, {pick(PRODUCTS, 'l_partkey % 6')} as product,
  {pick(BUY_TYPES, '(l_partkey // 6) % 6')} as buy_type_code,
  if(l_suppkey % 11 = 0, 'line-X', 'line-' || l_linestatus) as lob_gestion, {STATUS} as transaction_status,
  {DAY} as creation_date, {SHIP} as gestion_date, strftime(o_orderdate, '%Y-%m') as partition_period,
  cast(l_extendedprice as decimal(18,2)) as gb
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey""",
    "reservations": f"""
select cast(o_orderkey as varchar) as id, 'R' || o_orderkey as oid,
  case when o_orderkey % 7 = 0 then 'TO_CANCEL' when o_orderkey % 11 = 0 then null when o_orderstatus = 'F' then 'CONFIRMED'
    when o_orderstatus = 'O' then 'ACTIVE' else 'CANCELLED' end as status,
  {COUNTRY} as country_code, {CHANNEL} as channel, o_orderkey % 13 <> 0 as last_version, {DAY} as date,
  {pick(('FLIGHT_HOTEL', 'FLIGHT', 'CART'), 'o_orderkey % 3')} as shopping_flow_source
from {ORDERS}""",
    "cancellations": f"{CANCEL} union all {CANCEL} and o_orderkey % 10 = 0",
    "deferred": (
        f"{PROMISE} {DEADLINE.format(0)} from orders union all "
        f"{PROMISE} {DEADLINE.format(35)} from orders where o_orderkey % 15 = 0"
    ),
    "requests": f"""
select if(l_linenumber % 2 = 0, 'ext.', '') || 'u' || l_suppkey as created_user, strftime(l_shipdate, '%Y-%m') as creation_yearmonth,
  {SHIP} as creation_date, cast(l_orderkey as varchar) as transaction_code from lineitem""",
    "transactions": f"""
select cast(o_orderkey as varchar) as transaction_code,
  if(o_custkey % 4 = 0, 'WLAG', 'AG') || (o_custkey // 40) as partner_data_id, 'ag' || (o_custkey // 7) as agency_code,
  {NAME} as agency_fantasy_name, {CHANNEL} as channel, {PARENT} as parent_channel,
  if(o_custkey % 9 = 0, 'B2C', 'B2B') as line_of_business,
  if(o_orderkey % 101 = 0, null, cast(date_trunc('month', o_orderdate) as date)) as reservation_year_month,
  {DAY} as reservation_date, if(o_orderstatus <> 'O', {DAY} + cast(o_orderkey % 3 as int), null) as confirmation_date,
  if(o_orderstatus = 'P', {DAY} + cast(o_orderkey % 23 as int), null) as cancelation_date
from {ORDERS}""",
    "payroll": "select if(s_suppkey % 2 = 0, 'ext.', '') || if(s_suppkey % 3 = 2, 'left', 'u') || s_suppkey as ad_username from supplier",
    "forecast": f"select day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate) as fecha, {SHEET.format(other='false')}",
    "budget": f"""
select day(o_orderdate) || '-' || month(o_orderdate) || '-' || if(year(o_orderdate) >= 2000,
  lpad(cast(year(o_orderdate) - 2000 as varchar), 2, '0'), cast(year(o_orderdate) as varchar)) as fecha, {SHEET.format(other='o_orderkey % 2 <> 0')}""",
    "profit": f"""
select l_orderkey * 8 + l_linenumber as product_id, l_orderkey as transaction_code, {NET} as net_revenues_usd,
  {NET} * cast(l_discount as decimal(4,2)) as affiliates_usd, if(l_suppkey % 10 = 0, 'OTHER', 'B2B') as line_of_business,
  strftime(l_shipdate, '%Y-%m') as date_reservation_year_month from lineitem""",
    "corrections": "select cast(l_orderkey * 8 + l_linenumber as varchar) as product_id from lineitem",
    "marketing_funds": "select cast(l_orderkey * 8 + least(l_linenumber, 5) as varchar) as product_id from lineitem",
    "marketing_funds_2": "select cast(l_partkey as varchar) as product_id from lineitem",
    "quotations": f"""
select o_orderdate as created_at, case when o_custkey % 37 = 0 then '' when o_custkey % 41 = 0 then null
    else if(o_orderkey % 2 = 0, 'ag', 'AG') || (o_custkey // 7) end as agency_code,
  if(o_orderkey % 3 = 0, 'office', {pick((*CHANNELS, 'office'), 'o_custkey % 5')}) as channel_code from orders""",
    "products": f"""
select if(o_orderkey % 19 = 0, 'Q', 'P') || o_orderkey as transaction_id,
  case o_orderpriority when '1-URGENT' then 'REMOTE' when '2-HIGH' then 'CREDIT_CARD' when '3-MEDIUM' then 'WALLET'
    when '4-NOT SPECIFIED' then {pick(('DEFERRED_PAYMENT', 'DEFERRED_X', 'CASH', 'DEBIT_CARD'), 'o_orderkey % 4')}
    else (case o_orderkey % 4 when 0 then 'AGENCY_ACCOUNT' when 1 then 'CURRENT_ACCOUNT' when 3 then 'OTHER' end) end as payment_methods,
  if(o_orderkey % 5 = 0, null, o_orderkey % 5 < 3) as refundable,
  if(o_orderkey % 17 = 0, null, {DAY} + cast(o_custkey % 30 - 10 as int)) as penalty_start_date,
  case o_orderkey % 5 when 0 then 'AGENCY_CANCELED' when 1 then 'TIMEOUT_48' when 2 then 'BOOKING_ERROR' when 3 then 'OTHER' end as cancellation_reason
from orders""",
    "schedules": """
select 'S' || o_orderkey as id, cast(o_orderkey as varchar) as transaction_id, if(o_orderkey % 4 = 0, 'OPEN', 'CLOSED') as status,
  o_orderdate as created_at from orders""",
    "intentions": """
select 'I' || l_orderkey || '-' || l_linenumber as id, 'S' || l_orderkey as payment_schedule_id,
  if(l_linestatus = 'O' and l_suppkey % 5 = 4, 'PENDING', 'COLLECTED') as status from lineitem""",
    "scheduled_collections": """
select distinct 'I' || l_orderkey || '-' || l_linenumber as payment_intention_id,
  'C' || l_orderkey || '-' || l_linenumber as "collectionId" from lineitem""",
    "collections": """
select 'C' || l_orderkey || '-' || l_linenumber as cobra_id, 'R' || l_orderkey as reservation_id,
  case l_returnflag when 'R' then 'DWALLET' when 'A' then 'CARD' else 'PSE' end as channel_id from lineitem""",
    "payments": f"""
select cast(o_orderkey as varchar) as transaction_code, {COUNTRY} as country_code, {DAY} as reservation_date,
  cast(date_trunc('month', o_orderdate) as date) as reservation_year_month, cast(o_totalprice as decimal(18,2)) as gross_booking,
  if(o_orderstatus = 'P', 0, 1) as is_confirmed_flg from {ORDERS}""",
    "traffic": f"""
select 'v' || user_id || '-' || (dayofyear(ts) // 4) as visit, {PAGEVIEW} as pageview_id,
  {pick(TRAFFIC_PRODUCTS, f'{K} % 6')} as product,
  case event_type when 'view' then 'SEARCH' when 'purchase' then 'THANKS' else 'HOME' end as flow,
  {pick(VISIT_COUNTRIES, 'user_id % 8')} as country, {pick((*CHANNELS, 'office'), 'user_id % 5')} as channel,
  strftime(ts, '%Y-%m-%d') as date, if(event_id % 17 = 0, 0, 1) as ispageview, if(event_id % 13 = 0, 1, 0) as flg_detalle_cp,
  if(user_id % 19 = 0, 1, 0) as is_bot
from events""",
    # one row per filter name that carries a value, per source
    "used_filters": f"""
select source, cast(ts as date) as d, pageview_id, name from (
  select if(event_id % 3 = 0, 'map_a', 'map_b') as source, ts, {PAGEVIEW} as pageview_id,
    unnest(list_filter([if({K} % 3 > 0, 'price', null), if({K} % 2 > 0, 'stars', null), 'f' || ({K} % 5)], lambda x: x is not null)) as name
  {CLICK} and event_id % 3 < 2
  union all
  select 'array', ts, {PAGEVIEW}, 'n' || ({K} % 4) {CLICK} and event_id % 4 < 2 and {K} % 7 <> 0 and {K} % 5 <> 0 and {K} % 3 > 0
  union all
  select 'label', ts, {PAGEVIEW}, {pick(('sorting', 'ai-search', 'zone', 'length', 'price'), f'{K} % 5')} {CLICK}
    and event_id % 4 >= 2 and {K} % 8 <> 0 and {K} % 5 > 1 and {K} % 6 <> 0)""",
    "grid_events": f"""
select cast(ts as date) as d, {PAGEVIEW} as pageview_id, {pick(VISIT_COUNTRIES, 'user_id % 8')} as cc,
  if(event_type = 'click', 'click', 'show') as kind,
  {pick((fixed.GRID_SHOW, fixed.GRID_SHOW, fixed.GRID_TAB, fixed.GRID_CHEAPEST), f'{K} % 4')} as code
from events where event_type in ('view', 'click', 'error') and event_id % 11 <> 0 and {K} % 3 < 2""",
}


def with_roles(roles: str, body: str) -> str:
    """The body with the roles it names (comma separated) in front; the body starts with its own CTEs or SELECT."""
    ctes = ", ".join(f"{name} as ({ROLE_SQL[name].strip()})" for name in roles.replace(" ", "").split(","))
    body = body.strip()
    if body.startswith("with "):
        return f"with {ctes}, {body[5:]}"
    return f"with {ctes} {body}"
