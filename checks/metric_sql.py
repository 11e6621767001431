"""Comparison SQL of the named metrics: the plain definition of each, without the library's rewrites."""

from __future__ import annotations

from datetime import date, timedelta

from checks import roles as R
from checks.role_sql import with_roles
from kpiloom.functions import fixed
from kpiloom.operators.calendar import symmetric_window


def members(values) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def day(d: date) -> str:
    return f"date '{d.isoformat()}'"


def pct(a: str, b: str, digits: int = 2) -> str:
    return f"round(100e0 * ({a}) / nullif({b}, 0), {digits})"


def money(a: str, digits: int = 0) -> str:
    return f"cast(round({a}, {digits}) as double)"


def launches(table: dict, column: str) -> str:
    return f"case {column} " + " ".join(f"when '{c}' then {day(d)}" for c, d in table.items()) + " end"


F, S, I, C = R.FIRST, R.SECOND, R.IMPACT, R.CLICKS
CH = members(R.CHANNELS)
NOT_TEST = "coalesce(agency_name, '') not ilike '%test%'"
WEEK = "cast(date_trunc('week', {0}) as date)"
MONTH = "cast(date_trunc('month', {0}) as date)"

# First half -----------------------------------------------------------------------------------------------------------

PROMISED = f"""with promised as (
  select r.id, cast(d.deadline as date) as day, s.gb,
    if(s.transaction_status = 'Cancelado' and c.type = 'TIMEOUT_CLIENT', 'Time_out_client', r.status) as status
  from reservations r join deferred d on d.reservation_id = r.oid and d.reason = 'PROMISE-B2B' and d.deadline is not null
    left join cancellations c on c.reservation_id = r.oid
    left join (select * from sales where partition_period >= '{F.promise_sales_from}' and channel in {CH}) s
      on cast(s.transaction_code as varchar) = r.id
  where r.last_version and starts_with(r.channel, '{F.channel_prefix}'))"""
PROMISE_ROLES = "sales,reservations,cancellations,deferred"
LATE = "count(distinct id) filter (where status = 'Time_out_client')"
EARLY = f"select {WEEK.format('day')} as w, {MONTH.format('day')} as m, id, status from promised where day >= {day(F.weeks_from)}"

ASKED = """with staff as (
  select distinct if(starts_with(ad_username, 'ext.'), ad_username[5:], ad_username) as person from payroll),
asked as (
  select creation_yearmonth as ym, creation_date as d, agency_code,
    if(starts_with(created_user, 'ext.'), created_user[5:], created_user) as person
  from requests join transactions using (transaction_code)
  where creation_yearmonth >= '{0}' and creation_yearmonth in {1} and reservation_year_month is not null
    and line_of_business = 'B2B' and contains(channel, 'web-'))"""
ASK_MONTH = ASKED.format(F.requests_from, members(F.request_months))
ASK_WEEK = ASKED.format(F.requests_from, members(F.request_week_months))
ASK_ROLES = "requests,transactions,payroll"

SHEET_PRODUCT = "case producto " + " ".join(f"when '{k}' then '{v}'" for k, v in fixed.SHEET_PRODUCTS.items()) + " end"
SHEET_COUNTRY = "case pais " + " ".join(f"when '{k}' then '{v}'" for k, v in fixed.SHEET_COUNTRIES.items()) + " else 'O' end"
FACTORS = " ".join(f"when s.country_code = '{c}' then {v}" for c, v in fixed.FACTOR_BY_COUNTRY.items())


def revenue_cte(since: date, services: str = "Dest. Serv") -> str:
    return f"""with line as (
  select s.gestion_date as gd,
    case when s.partner_id in {members(fixed.OTHER_PARTNERS)} then 'O'
      when s.country_code in {members(fixed.REVENUE_COUNTRIES)} then s.country_code else 'O' end as pais,
    case when s.buy_type_code in ('Bundles', 'Carrito') then 'Paquetes'
      when s.buy_type_code in ('Actividades', 'Traslados') then '{services}' else s.buy_type_code end as producto,
    if(s.country_code = 'BR' and s.product <> 'Vuelos', p.net_revenues_usd - p.affiliates_usd, p.net_revenues_usd)
      * (case when s.country_code = 'BR' then 0.92 {FACTORS} else 0.97 end) as rev
  from sales s join profit p using (product_id) join transactions t on t.transaction_code = cast(p.transaction_code as varchar)
  where s.gestion_date >= {day(since)} and s.partition_period >= '{F.revenue_period_from}' and s.lob_gestion in {members(F.revenue_lines)}
    and s.parent_channel = 'Agencias afiliadas' and p.line_of_business = 'B2B'
    and p.date_reservation_year_month >= '{F.revenue_period_from}' and t.reservation_year_month >= {day(F.revenue_from)})"""


def kr31(sources=("FCST", "BDGT"), services: str = "Dest. Serv") -> str:
    sheets = {"FCST": ("forecast", "/"), "BDGT": ("budget", "-")}
    union = " union all ".join(
        f"select '{k}' as source, split_part(fecha, '{sheets[k][1]}', 3) as y, * from {sheets[k][0]} where lob_canal = 'B2B-MIN'"
        for k in sources
    )
    return with_roles(
        "sales,profit,transactions,forecast,budget",
        revenue_cte(F.revenue_from, services) + f""",
plan as (
  select source, if(length(y) = 2, 2000, 0) + cast(y as int) as y, cast(no_mes_proyectado as int) as m, {SHEET_PRODUCT} as producto,
    {SHEET_COUNTRY} as pais, round(sum(cast(net_revenue as decimal(15,6))), 2) as target
  from ({union}) group by all),
made as (select year(gd) as y, month(gd) as m, pais, producto, round(sum(rev), 2) as real from line group by all)
select y || '-' || lpad(cast(m as varchar), 2, '0') as periodo, cast(sum(real) as double) as net_rev_real,
  cast(sum(target) as double) as net_rev_target
from plan full join made using (y, m, pais, producto) where y in {members(F.revenue_years)} group by all""",
    )


def activation_ctes(since: date, until: date) -> str:
    return f"""with quote as (
  select cast(created_at as date) as d, upper(agency_code) as a from quotations
  where cast(created_at as date) between {day(since)} and {day(until)} and channel_code in {CH} and agency_code <> ''),
sold as (
  select creation_date as d, upper(agency_code) as a from sales
  where creation_date between {day(since)} and {day(until)} and transaction_status = 'Confirmado' and channel in {CH})"""


BOOKED = f"""with booked as (
  select s.creation_date as d, year(s.creation_date) * 100 + month(s.creation_date) as mes, s.partner_id as p, s.transaction_code as tx
  from sales s join reservations r on r.id = cast(s.transaction_code as varchar)
  where r.last_version and r.status <> 'TO_CANCEL' and s.channel in {members(F.wide_channels)} and s.creation_date > {day(F.bookings_after)}
    and s.partition_period >= '{F.bookings_after:%Y-%m}'),
per_month as (select mes, p, count(distinct tx) as n from booked group by all),
base as (
  select mes as before, if(mes % 100 = 12, mes + 89, mes + 1) as after, p, n from per_month
  where n between 1 and 3 and mes >= {F.uplift_month_from})"""
UPLIFT = f"""{BOOKED},
grown as (
  select before, after, base.p, coalesce(e.n, 0) >= base.n + 2 as up
  from base left join per_month e on e.p = base.p and e.mes = base.after),
size as (select mes, count(distinct p) as n from per_month group by all)"""

FIRST: dict[str, str] = {
    "kr21": with_roles(
        PROMISE_ROLES,
        f"""{PROMISED} select {MONTH.format('day')} as mes_deadline, status, count(distinct id) as reservas, {money('sum(gb)', 2)} as gb
from promised where day <= {day(F.as_of)} group by all""",
    ),
    "kr21_sem": with_roles(
        PROMISE_ROLES,
        f"""{PROMISED} select w as semana_inicio, count(distinct id) as total_reservas, {LATE} as reservas_timeout_client,
  {pct(LATE, 'count(distinct id)')} as pct_timeout_client from ({EARLY}) group by all""",
    ),
    "kr21_sem_cum": with_roles(
        PROMISE_ROLES,
        f"""{PROMISED}, e as ({EARLY}), spine as (select distinct w, m from e)
select spine.w as semana_inicio, spine.m as mes_deadline, count(distinct id) as total_reservas_acum, {LATE} as timeouts_acum,
  {pct(LATE, 'count(distinct id)')} as pct_timeout_acum
from spine join e on e.m = spine.m and e.w <= spine.w group by all""",
    ),
    "kr22": with_roles(
        ASK_ROLES,
        f"""{ASK_MONTH} select cast(count(staff.person) as bigint) as cant_staff, cast(count(*) - count(staff.person) as bigint) as cant_no_staff,
  count(*) as cant_total, count(distinct agency_code) as cant_agencias_unicas, ym as creation_yearmonth
from asked left join staff on staff.person = asked.person group by ym""",
    ),
    "kr22_sem": with_roles(
        ASK_ROLES,
        f"{ASK_WEEK} select {WEEK.format('d')} as semana_inicio, count(distinct agency_code) as cant_agencias_unicas from asked group by all",
    ),
    "kr22_sem_cum": with_roles(
        ASK_ROLES,
        f"""{ASK_WEEK}, e as (select distinct {WEEK.format('d')} as w, {MONTH.format('d')} as m, agency_code as a from asked),
spine as (select distinct w, m from e)
select spine.w as semana_inicio, count(distinct a) as cant_agencias_acum_mes
from spine join e on e.m = spine.m and e.w <= spine.w group by spine.w""",
    ),
    "kr31": kr31(),
    "kr31_sem": with_roles(
        "sales,profit,transactions",
        f"{revenue_cte(F.weeks_from)} select {WEEK.format('gd')} as semana_inicio, {money('sum(rev)', 2)} as net_revenue_real from line group by all",
    ),
    "kr31_sem_cum": with_roles(
        "sales,profit,transactions",
        f"""{revenue_cte(F.weeks_from)}, e as (select {WEEK.format('gd')} as w, {MONTH.format('gd')} as m, sum(rev) as rev from line group by all),
spine as (select distinct w, m from e)
select spine.w as semana_inicio, {money('sum(rev)', 2)} as net_revenue_acum_mes
from spine join e on e.m = spine.m and e.w <= spine.w group by spine.w""",
    ),
    "kr32": with_roles(
        "sales,quotations",
        f"""{activation_ctes(F.activation_from, F.as_of)}
select {MONTH.format('q.d')} as mes, count(distinct q.a) as agencias_cotizadoras,
  count(distinct q.a) filter (where v.a is not null) as agencias_cotizaron_y_vendieron, count(*) as cotizaciones_realizadas,
  {pct('count(distinct q.a) filter (where v.a is not null)', 'count(distinct q.a)')} as pct_activacion_comercial
from quote q left join (select distinct {MONTH.format('d')} as m, a from sold) v on v.a = q.a and v.m = {MONTH.format('q.d')} group by all""",
    ),
    "kr32_sem": with_roles(
        "sales,quotations",
        f"""{activation_ctes(F.weeks_from, F.weeks_to)}
select {WEEK.format('q.d')} as semana_inicio, count(distinct q.a) as agencias_cotizadoras,
  count(distinct q.a) filter (where v.a is not null) as agencias_cotizaron_y_vendieron,
  {pct('count(distinct q.a) filter (where v.a is not null)', 'count(distinct q.a)')} as pct_activacion_comercial
from quote q left join (select distinct {WEEK.format('d')} as w, a from sold) v on v.a = q.a and v.w = {WEEK.format('q.d')} group by all""",
    ),
    "kr32_sem_cum": with_roles(
        "sales,quotations",
        f"""{activation_ctes(F.weeks_from, F.weeks_to)},
q as (select distinct {WEEK.format('d')} as w, {MONTH.format('d')} as m, a from quote),
v as (select distinct {WEEK.format('d')} as w, {MONTH.format('d')} as m, a from sold),
spine as (select distinct w, m from q)
select spine.w as semana_inicio, count(distinct q.a) as agencias_cotizadoras_acum,
  count(distinct q.a) filter (where v.a is not null) as agencias_compraron_acum,
  {pct('count(distinct q.a) filter (where v.a is not null)', 'count(distinct q.a)')} as pct_activacion_acum
from spine join q on q.m = spine.m and q.w <= spine.w left join v on v.a = q.a and v.m = spine.m and v.w <= spine.w
group by spine.w""",
    ),
    "kr33": with_roles(
        "sales,reservations",
        f"""{UPLIFT} select before as mes_previo, after as mes_evaluacion, any_value(a.n) as agencias_total_previo,
  any_value(b.n) as agencias_total_evaluado, count(distinct p) as agencias_1_3_previo, count(distinct p) filter (where up) as agencias_aumentaron,
  {pct('count(distinct p) filter (where up)', 'count(distinct p)')} as pct_aumento, 25e0 as target_pct,
  round(count(distinct p) filter (where up) * 100e0 / nullif(count(distinct p), 0) / 25e0 * 100, 2) as pct_cumplimiento_target
from grown left join size a on a.mes = before left join size b on b.mes = after group by before, after""",
    ),
    "kr33_sem": with_roles(
        "sales,reservations",
        f"""{UPLIFT}, rate as (select after, {pct('count(distinct p) filter (where up)', 'count(distinct p)')} as pct_aumento from grown group by all)
select w.semana_inicio, rate.pct_aumento from rate join (
  select distinct {WEEK.format('creation_date')} as semana_inicio, year(creation_date) * 100 + month(creation_date) as mes
  from sales where creation_date >= {day(F.weeks_from)}) w on w.mes = rate.after""",
    ),
    "kr33_sem_cum": with_roles(
        "sales,reservations",
        f"""{BOOKED},
per_week as (
  select {WEEK.format('d')} as w, mes, p, count(distinct tx) as n from booked where d >= {day(F.weeks_from)} group by all),
spine as (select distinct w, mes from per_week),
so_far as (
  select spine.w, spine.mes, p, sum(n) as n from spine join per_week e on e.mes = spine.mes and e.w <= spine.w group by all)
select spine.w as semana_inicio, count(distinct base.p) as agencias_1_3_previo,
  count(distinct base.p) filter (where coalesce(f.n, 0) >= base.n + 2) as agencias_aumentaron,
  {pct('count(distinct base.p) filter (where coalesce(f.n, 0) >= base.n + 2)', 'count(distinct base.p)')} as pct_aumento_acum
from spine join base on base.after = spine.mes left join so_far f on f.p = base.p and f.w = spine.w group by spine.w""",
    ),
}

# Second half ----------------------------------------------------------------------------------------------------------


def values(rows) -> str:
    def lit(v):
        return day(v) if isinstance(v, date) else f"'{v}'" if isinstance(v, str) else repr(v)

    return "(values " + ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows) + ")"


STATES = f"""with cal as (select * from {values(S.calendar)} c(periodo, desde, hasta, n_sem)),
wk as (
  select periodo, desde, k as semana, desde + 7 * (k - 1) as s_desde, desde + 7 * k - 1 as s_hasta,
    least(desde + 7 * k, {day(S.as_of)}) as foto, if(desde + 7 * k <= {day(S.as_of)}, 'CIERRE', 'EN_CURSO') as estado
  from (select *, cast(unnest(range(1, n_sem + 1)) as int) as k from cal) where desde + 7 * (k - 1) <= {day(S.as_of)}),
state as (
  select periodo, semana, if(starts_with(partner_data_id, 'WLAG'), partner_data_id[3:], partner_data_id) as ag,
    (reservation_date - desde) // 7 + 1 as w,
    coalesce(confirmation_date <= foto, false) and coalesce(cancelation_date > foto, true) as conf
  from wk join transactions on reservation_date between desde and s_hasta
  where reservation_year_month >= {day(S.orders_month_from)} and reservation_date >= {day(S.orders_from)}
    and parent_channel = 'Agencias afiliadas' and line_of_business = 'B2B'),
bought as (
  select periodo, semana, ag, count(distinct w) filter (where conf) as weeks, bool_or(conf and w = semana) as now
  from state group by all),
m as (
  select periodo, semana, count(*) filter (where weeks >= 3) as freq, count(*) filter (where now) as buying
  from bought group by all)"""

SECOND: dict[str, str] = {
    "kr11": with_roles(
        "sales,products",
        f"""with target as (select * from {values(S.own_method_targets)} t(mes, target)),
paid as (
  select partition_period as mes, sum(gb) filter (where regexp_matches(payment_methods, 'WALLET|CURRENT_ACCOUNT|AGENCY_ACCOUNT')) as own,
    sum(gb) as total
  from sales join products on transaction_id = origin_product_id
  where partition_period >= '{S.own_methods_from}' and contains(channel, 'web-') and transaction_status = 'Confirmado' group by all)
select mes, cast(coalesce(own, 0) as double) as gb_metodo_propio, cast(coalesce(total, 0) as double) as gb_total_usd, cast(target as double) as target,
  {pct('cast(coalesce(own, 0) as double)', 'cast(target as double)', 1)} as pct_cumplimiento
from target left join paid using (mes)""",
    ),
    "kr21": with_roles(
        "sales,quotations",
        f"""{activation_ctes(S.quoting_from, S.quoting_to)}, target as (select * from {values(S.quoting_targets)} t(mes, semanas, target))
select mes, semanas, count(distinct a) as agencias_cotizadoras, target, {pct('count(distinct a)', 'target', 1)} as pct_cumplimiento
from target left join quote on {MONTH.format('d')} = mes group by mes, semanas, target""",
    ),
    "kr22": with_roles(
        "transactions",
        f"""{STATES}, target as (select * from {values(S.frequent_targets)} t(mes, semanas, target)),
latest as (select * from m join wk using (periodo, semana) qualify row_number() over (partition by periodo order by semana desc) = 1)
select mes as mes_comercial, semanas, coalesce(estado, 'PENDIENTE') as estado, coalesce(freq, 0) as agencias_frecuentes, target,
  {pct('coalesce(freq, 0)', 'target', 1)} as pct_cumplimiento
from target left join latest on periodo = mes""",
    ),
    "kr21_sem": with_roles(
        "sales,quotations",
        f"""{activation_ctes(S.quoting_from, S.quoting_to)}, e as (select {WEEK.format('d')} as w, {MONTH.format('d')} as m, a from quote),
spine as (select w, m, count(distinct a) as n from e group by all)
select spine.m as mes, spine.w as semana_inicio, any_value(n) as agencias_semana, count(distinct a) as agencias_acum_mes
from spine join e on e.m = spine.m and e.w <= spine.w group by all""",
    ),
    "kr22_sem": with_roles(
        "transactions",
        f"""{STATES} select periodo as mes_comercial, semana, strftime(s_desde, '%Y-%m-%d') as semana_inicio, estado,
  coalesce(buying, 0) as compradoras_semana, coalesce(freq, 0) as frecuentes_acum from wk left join m using (periodo, semana)""",
    ),
}

# Initiatives ----------------------------------------------------------------------------------------------------------

LINK_FROM = min(I.link_launches.values())


def hotel_cte(since: date) -> str:
    return f"""with hotel as (
  select creation_date as d, country_code as c, partner_id as p, agency_name as an, transaction_code as r, transaction_status as st, gb,
    refundable as rf, payment_methods as pm, coalesce(penalty_start_date >= creation_date, false) as fut,
    {launches(I.link_launches, 'country_code')} as ld,
    coalesce(not refundable and contains(payment_methods, 'REMOTE') and penalty_start_date >= creation_date, false) as is_link
  from sales left join products on transaction_id = origin_product_id
  where channel in {CH} and creation_date >= {day(since)} and product = 'Hoteles' and country_code in {members(I.link_launches)} and {NOT_TEST})"""


LINK = hotel_cte(LINK_FROM)
LINK_COUNTS = f"""count(distinct r) filter (where st = 'Confirmado') as nl, {money("sum(gb) filter (where st = 'Confirmado')")} as gl,
  count(distinct p) filter (where st = 'Confirmado') as ag, count(distinct r) filter (where st = 'Cancelado') as nc,
  {money("sum(gb) filter (where st = 'Cancelado')")} as gc"""
MIX_FROM = LINK_FROM - timedelta(days=7 * fixed.MIX_PRE_BLOCKS)
CF_FROM = LINK_FROM - timedelta(days=7 * max(fixed.FIT_WINDOWS))
MIX_CASE = (
    f"case when contains(pm, 'REMOTE') then if(fut, '{fixed.LINK_NEW}', '{fixed.LINK_OLD}') "
    + " ".join(f"when contains(pm, '{k}') then '{v}'" for k, v in fixed.MIX_LABELS) + f" else '{fixed.OTHERS}' end"
)
LDP_MIX = with_roles(
    "sales,products",
    f"""{hotel_cte(MIX_FROM)} select cast(d as varchar) as d, c, {MIX_CASE} as g, count(distinct r) as n, {money('sum(gb)')} as gb
from hotel where st = 'Confirmado' and not rf group by all""",
)
CF_DAILY = with_roles(
    "sales,products",
    f"""{hotel_cte(CF_FROM)} select cast(d as varchar) as d, c, {money('sum(gb) filter (where not rf)')} as gl, {money('sum(gb)')} as gt
from hotel where st = 'Confirmado' group by all""",
)
WALLET_FROM = min(I.wallet_launches.values())
WALLET_PRE = WALLET_FROM - timedelta(days=fixed.WALLET_PRE_DAYS)


def wallet_cte(since: date, scope: str) -> str:
    month = day(since.replace(day=1))
    return f"""with method as (
  select distinct ps.transaction_id as tx, cc.channel_id as ch
  from schedules ps join intentions pi on pi.payment_schedule_id = ps.id
    join scheduled_collections sc on sc.payment_intention_id = pi.id join collections cc on cc.cobra_id = sc."collectionId"
    join reservations r on r.oid = cc.reservation_id
  where r.last_version and r.channel in {CH} and pi.status = 'COLLECTED' and ps.status = 'CLOSED' and ps.created_at >= {day(since)}),
combo as (
  select tx, string_agg(ch, '+' order by ch) filter (where ch <> 'DWALLET') as partner from method group by tx
  having count(*) >= 2 and bool_or(ch = 'DWALLET')),
pay as (
  select m.reservation_date as d, m.country_code as c, t.transaction_code as r, t.partner_data_id as p, m.gross_booking as gb,
    combo.tx is not null as w, combo.partner
  from payments m join transactions t using (transaction_code) left join combo on combo.tx = t.transaction_code
  where m.reservation_year_month >= {month} and t.reservation_year_month >= {month} and m.is_confirmed_flg = 1 and t.channel in {CH}
    and m.country_code in {members(I.wallet_launches)} and coalesce(t.agency_fantasy_name, '') not ilike '%test%'
    and m.reservation_date >= {scope})"""


WALLET_SCOPE = wallet_cte(WALLET_FROM, launches(I.wallet_launches, "m.country_code"))
WALLET_ROLES = "schedules,intentions,scheduled_collections,collections,reservations,payments,transactions"
PP_DAYS, PP_FROM = symmetric_window(I.promise_launch, I.as_of)
PKG_FROM = I.deferred_launch - timedelta(days=7 * max(fixed.FIT_WINDOWS))
GV_FROM = I.grid_launch - timedelta(days=7 * fixed.GRID_PRE_WEEKS)
GROUP_CASE = "case product " + " ".join(f"when '{k}' then '{v}'" for k, v in fixed.PROMISE_GROUPS.items()) + " else 'OT' end"
PROMISE = f"""with pledged as (
  select r.id, r.date from reservations r where r.last_version and starts_with(r.channel, 'web')
    and exists (from deferred d where d.reservation_id = r.oid and d.reason = 'PROMISE-B2B')),
line as (
  select creation_date as d, country_code as c, partner_id as p, transaction_code as tx, {GROUP_CASE} as g,
    case transaction_status when 'Confirmado' then 'C' when 'Activo' then 'A' when 'Cancelado' then 'X' end as st, gb,
    if(cast(transaction_code as varchar) in (select id from pledged where date >= {day(PP_FROM)}), 1, 0) as prom,
    payment_methods as pmt, cancellation_reason as cr
  from sales left join products on transaction_id = origin_product_id
  where channel in {CH} and creation_date >= {day(PP_FROM)} and creation_date < {day(I.as_of)} and {NOT_TEST}),
v as (
  select *, if(g in ('AU', 'TR', 'AS', 'AC'), 1, 0) as nw, d >= {day(I.promise_launch)} as post from line
  where st is not null and (prom = 1 or st in ('C', 'A') or g in ('AU', 'TR', 'AS', 'AC')))"""
PROMISE_ROLES_PP = "sales,products,reservations,deferred"


def tx(where: str) -> str:
    return f"count(distinct tx) filter (where {where})"


LDP_COUNTRY = with_roles(
    "sales,products",
    f"""{LINK}, scope as (select * from hotel where d >= ld), link as (from scope where is_link),
again as (select c, p from link where st = 'Confirmado' group by all having count(distinct r) >= 2),
again_all as (select p from link where st = 'Confirmado' group by all having count(distinct r) >= 2)
select link.c, cast(max(ld) as varchar) as ld, {LINK_COUNTS}, coalesce(any_value(a.n), 0) as rep
from link left join (select c, count(*) as n from again group by c) a on a.c = link.c group by link.c
union all select 'ALL', '', {LINK_COUNTS}, (select count(*) from again_all) from link
union all select 'TOT', '', {LINK_COUNTS}, 0 from scope""",
)
LDP_TOTALS = with_roles(
    "sales,products",
    f"""{LINK}, x as (select * from hotel where d >= ld and st = 'Confirmado' and not rf)
select c, {money('sum(gb)')} as gt, count(distinct r) as nt, count(distinct p) as agt from x group by c
union all select 'ALL', {money('sum(gb)')}, count(distinct r), count(distinct p) from x""",
)
LDP_DAILY = with_roles(
    "sales,products",
    f"""{LINK}, x as (select *, d >= ld as inside, is_link and d >= ld as isl from hotel where st = 'Confirmado')
select cast(d as varchar) as d, c, {money('sum(gb) filter (where rf and not isl)')} as ref,
  {money('sum(gb) filter (where not rf and not isl)')} as non, {money('sum(gb) filter (where isl)')} as link,
  {money('sum(gb) filter (where rf is null)')} as sd, {money('sum(gb) filter (where inside)')} as scope,
  count(distinct r) filter (where isl) as nl, {money('sum(gb) filter (where inside and not rf)')} as scope_nr
from x group by all""",
)
WALLET_DAILY = with_roles(
    WALLET_ROLES,
    f"""{wallet_cte(WALLET_PRE, day(WALLET_PRE))} select cast(d as varchar) as d, c, count(distinct r) filter (where w) as nw,
  {money('sum(gb) filter (where w)')} as gw, count(distinct r) as nt, {money('sum(gb)')} as gt from pay group by all""",
)
WALLET_AGENCIES = with_roles(
    WALLET_ROLES,
    f"""{WALLET_SCOPE} select c, count(distinct p) filter (where w) as agw, count(distinct p) as agt from pay group by c
union all select 'ALL', count(distinct p) filter (where w), count(distinct p) from pay""",
)
PD_DAILY = with_roles(
    "sales",
    f"""select cast(creation_date as varchar) as d, count(distinct transaction_code) as n, {money('sum(gb)', 2)} as gb from sales
where channel in {CH} and creation_date >= {day(I.deferred_launch)} and country_code = 'AR' and transaction_status = 'Confirmado' group by all""",
)
PKG_DAILY = with_roles(
    "sales,reservations,products",
    f"""with x as (
  select creation_date, country_code as c, transaction_code as r, gb, coalesce(payment_methods = 'DEFERRED_PAYMENT', false) as later
  from sales join reservations v on v.id = cast(transaction_code as varchar) and v.last_version and v.shopping_flow_source = 'FLIGHT_HOTEL'
    left join products on transaction_id = origin_product_id
  where sales.channel in {CH} and creation_date >= {day(PKG_FROM)} and transaction_status = 'Confirmado'
    and sales.country_code in {members(I.package_countries)} and {NOT_TEST})
select cast(creation_date as varchar) as d, c, {money('sum(gb)')} as gb, count(distinct r) as n,
  {money('sum(gb) filter (where later)')} as gb_pd, count(distinct r) filter (where later) as n_pd from x group by all""".replace("country_code as c", "sales.country_code as c"),
)
GV_DAILY = with_roles(
    "sales,reservations",
    f"""with x as (
  select creation_date, sales.country_code as c, transaction_code as r, gb, shopping_flow_source as flow
  from sales join reservations v on v.id = cast(transaction_code as varchar) and v.last_version
  where sales.channel in {CH} and creation_date >= {day(GV_FROM)} and transaction_status = 'Confirmado' and product = 'Vuelos'
    and sales.country_code in {members(I.grid_countries)} and {NOT_TEST} and shopping_flow_source in ('FLIGHT', 'CART'))
select cast(creation_date as varchar) as d, c, {money("sum(gb) filter (where flow = 'FLIGHT')")} as gb_f,
  count(distinct r) filter (where flow = 'FLIGHT') as n_f, {money("sum(gb) filter (where flow = 'CART')")} as gb_c,
  count(distinct r) filter (where flow = 'CART') as n_c from x group by all""",
)
PP_A = with_roles(
    PROMISE_ROLES_PP,
    f"""{PROMISE} select cast(d as varchar) as d, c, g, st, prom, count(distinct tx) as n, {money('sum(gb)')} as gb
from (from v union all select * replace ('TT' as g) from v) group by d, c, g, st, prom""",
)

INITIATIVES: dict[str, str] = {
    "ldp_daily": LDP_DAILY,
    "ldp_country": LDP_COUNTRY,
    "ldp_totals": LDP_TOTALS,
    "ldp_top": with_roles(
        "sales,products",
        f"""{LINK} select p, max(an) as an, max(c) as c, count(distinct r) as n, {money('sum(gb)')} as g
from hotel where d >= ld and st = 'Confirmado' and is_link group by p order by g desc, p limit 10""",
    ),
    "ldp_mix": LDP_MIX,
    "cf_daily": CF_DAILY,
    "wallet_daily": WALLET_DAILY,
    "wallet_agencies": WALLET_AGENCIES,
    "wallet_mix": with_roles(
        WALLET_ROLES,
        f"{WALLET_SCOPE} select c, partner, count(distinct r) as n, {money('sum(gb)')} as gb from pay where w group by all",
    ),
    "pd_daily": PD_DAILY,
    "pkg_daily": PKG_DAILY,
    "gv_daily": GV_DAILY,
    "pp_a": PP_A,
    "pp_m": with_roles(
        PROMISE_ROLES_PP,
        f"""{PROMISE}, x as (select *, case when prom = 1 then 'Promesa de pago' when contains(pmt, 'REMOTE') then 'Link de pago'
    when contains(pmt, 'CREDIT_CARD') then 'Tarjeta crédito' when contains(pmt, 'DEBIT') then 'Tarjeta débito'
    when pmt = 'CASH' then 'Efectivo' when pmt = 'AGENCY_ACCOUNT' then 'Cuenta de la agencia' when pmt = 'WALLET' then 'Wallet'
    when starts_with(pmt, 'DEFERRED') then 'Diferido / gestor' else 'Otros' end as m from v where st = 'C' and nw = 1)
select cast(d as varchar) as d, c, m, count(distinct tx) as n, {money('sum(gb)')} as gb from x group by all""",
    ),
    "pp_x": with_roles(
        PROMISE_ROLES_PP,
        f"""{PROMISE}, x as (select *, case when nw = 1 then 'NU' when g in ('HO', 'AL') then 'HO' else 'OT' end as g2,
    case when cr = 'AGENCY_CANCELED' then 'Cancela la agencia' when starts_with(cr, 'TIMEOUT') then 'Vence sin pago'
      when cr = 'BOOKING_ERROR' then 'Error de reserva' else 'Otros' end as r from v where st = 'X' and prom = 1)
select cast(d as varchar) as d, c, g2, r, count(distinct tx) as n from x group by all""",
    ),
    "pp_ctl": with_roles(
        PROMISE_ROLES_PP,
        f"""{PROMISE} select p, max(c) as c, {tx("st = 'C' and nw = 1 and not post")} as pre_n,
  {money("sum(gb) filter (where st = 'C' and nw = 1 and not post)")} as pre_gb, {tx("st = 'C' and nw = 1 and post")} as post_n,
  {money("sum(gb) filter (where st = 'C' and nw = 1 and post)")} as post_gb,
  {tx("st in ('A', 'C') and nw = 1 and prom = 1 and post")} as post_prom, {tx("st = 'C' and nw = 1 and prom = 1 and post")} as post_prom_c
from v group by p having bool_or(st = 'C' and nw = 1)""",
    ),
    "pp_ag": with_roles(
        PROMISE_ROLES_PP,
        f"""{PROMISE}, hist as (
  select distinct partner_id as p from sales where channel in {CH} and creation_date < {day(PP_FROM)}
    and partition_period >= '{I.promise_history_from:%Y-%m}' and {NOT_TEST} and cast(transaction_code as varchar) in (
      select id from pledged where date >= {day(I.promise_history_from)} and date < {day(PP_FROM)}))
select p, max(c) as c, {tx("prom = 1 and nw = 0 and not post and st = 'A'")} as pre_h_a, {tx("prom = 1 and nw = 0 and not post and st = 'C'")} as pre_h_c,
  {tx("prom = 1 and nw = 0 and post and st = 'A'")} as post_h_a, {tx("prom = 1 and nw = 0 and post and st = 'C'")} as post_h_c,
  {tx("prom = 1 and nw = 1 and post and st = 'A'")} as post_n_a, {tx("prom = 1 and nw = 1 and post and st = 'C'")} as post_n_c,
  {tx("st = 'C' and not post")} as act_pre, if(p in (select p from hist), 1, 0) as hist_prom
from v group by p having bool_or(prom = 1 and st in ('A', 'C'))""",
    ),
    "pp_agw": with_roles(
        PROMISE_ROLES_PP,
        f"""{PROMISE} select cast(floor((d - {day(I.promise_launch)}) / 7) as int) as w, count(distinct p) filter (where st in ('A', 'C')) as ag_ac,
  count(distinct p) filter (where st = 'C') as ag_c from v where prom = 1 group by all""",
    ),
}

# Clicks ---------------------------------------------------------------------------------------------------------------

GRAINS = {"d": "cast(d as varchar)", "w": "cast(cast(date_trunc('week', d) as date) as varchar)", "m": "strftime(d, '%Y-%m')", "t": "'total'"}
REAL_PAGE = f"ispageview = 1 and flg_detalle_cp = 0 and is_bot = 0 and channel in {CH}"


def gv_ctr(grain: str) -> str:
    return f"""with hit as (
  select {GRAINS[grain]} as p, cc as c, visit, bool_or(kind = 'show' and code = '{fixed.GRID_SHOW}') as s,
    bool_or(kind = 'click' and code = '{fixed.GRID_SHOW}') as ct, bool_or(kind = 'click' and code = '{fixed.GRID_TAB}') as ca,
    bool_or(kind = 'click' and code = '{fixed.GRID_CHEAPEST}') as ch
  from grid_events join traffic using (pageview_id)
  where traffic.product = 'FLIGHTS' and flow = 'SEARCH' and date >= '{C.grid_launch}' and d >= {day(C.grid_launch)}
    and cc in {members(C.grid_countries)} and {REAL_PAGE} group by all)
select '{grain}' as grain, p, c, count(*) as shows, count(*) filter (where ct) as c_tab, count(*) filter (where ca) as c_any,
  count(*) filter (where ch) as c_cheap from hit where s group by all"""


def in_week(d: str) -> str:
    return f"{day(C.anchor)} + cast(7 * (({d} - {day(C.anchor)}) // 7) as int)"


BOARD_PRODUCT = "case product " + " ".join(f"when '{k}' then '{v[0]}'" for k, v in fixed.USAGE_PRODUCTS.items()) + " end"
BOARD_SOURCE = "case product " + " ".join(f"when '{k}' then '{v[1]}'" for k, v in fixed.USAGE_PRODUCTS.items()) + " end"
USAGE = f"""with page as (
  select {BOARD_PRODUCT} as product, {BOARD_SOURCE} as source, {in_week("cast(date as date)")} as w,
    if(country in {members(fixed.USAGE_COUNTRIES)}, country, 'OT') as cg, visit, pageview_id, flow
  from traffic where {REAL_PAGE} and date between '{R.USAGE_FROM}' and '{R.USAGE_TO}'),
used as (
  select distinct page.product, page.w, cg, name, visit from page join used_filters u
    on u.source = page.source and u.pageview_id = page.pageview_id and {in_week("u.d")} = page.w
  where flow = 'SEARCH' and u.d between {day(R.USAGE_FROM)} and {day(R.USAGE_TO)}),
bought as (select distinct product, w, cg, visit from page where flow = 'THANKS'),
per_filter as (
  select used.product, used.w, used.cg, name, count(distinct used.visit) as clicks, count(distinct bought.visit) as thanks
  from used left join bought on (bought.product, bought.w, bought.cg, bought.visit) = (used.product, used.w, used.cg, used.visit) group by all),
visits as (select product, w, cg, count(distinct visit) as visits from page where flow = 'SEARCH' group by all),
usage as (
  select v.product, v.w as week_start, v.cg as country, v.visits, f.name as filter_name, coalesce(f.clicks, 0) as clicks, coalesce(f.thanks, 0) as thanks
  from visits v left join per_filter f on (f.product, f.w, f.cg) = (v.product, v.w, v.cg))"""

USAGE_ROLES = "traffic,used_filters"
CLICKS: dict[str, str] = {
    **{f"gv_ctr_{g}": with_roles("traffic,grid_events", gv_ctr(g)) for g in GRAINS},
    "filter_usage": with_roles(USAGE_ROLES, f"{USAGE} select * from usage"),
    "filter_usage_total": with_roles(
        USAGE_ROLES,
        f"""{USAGE}, v as (select product, week_start, cast(sum(visits) as bigint) as visits_sum from (
  select distinct product, week_start, country, visits from usage) group by all),
f as (select product, week_start, filter_name, cast(sum(clicks) as bigint) as clicks_sum, cast(sum(thanks) as bigint) as thanks_sum
  from usage where filter_name is not null group by all)
select product, week_start, visits_sum, filter_name, clicks_sum, thanks_sum from v left join f using (product, week_start)""",
    ),
    "filter_usage_text": with_roles(
        USAGE_ROLES,
        f"""{USAGE} select product, week_start, country, visits,
  coalesce(string_agg(filter_name || ' ' || clicks || ' ' || thanks, ';' order by clicks desc, filter_name) filter (where filter_name is not null), '') as s
from usage group by all""",
    ),
}
