"""Single operators over the given tables, each beside its comparison SQL."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import functions as F

from checks import roles as R
from checks.metric_sql import FIRST, MONTH, SECOND, USAGE, USAGE_ROLES, WEEK, day, launches, members, pct
from checks.pairs import Pairs
from checks.role_sql import with_roles
from kpiloom.functions import dates, fixed, text
from kpiloom.functions.numbers import half_even, money, ratio, rounded
from kpiloom.functions.numbers import pct as pct_column
from kpiloom.operators import aggregate, calendar, cohort, cumulative, joins, rollout, scorecard
from kpiloom.operators.funnel import clean_pages
from kpiloom.plans import first_half, initiatives, registry, second_half, usability
from kpiloom.session import scratch_path
from kpiloom.sources import snapshots
from kpiloom.sources.tables import Tables, repeated_side_keys
from kpiloom.streaming import running, weekly

pairs = Pairs()
add = pairs.add
AS_OF = R.MAX_DAY


def over(table, function):
    return lambda spark, sf_dir: function(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def role(function, settings=R.FIRST):
    return lambda spark, sf_dir: function(R.roles(spark, sf_dir), settings)


def bookings(orders):
    """Orders as day, month, week, agency, value."""
    d = F.to_date("o_orderdate")
    return orders.select(
        d.alias("d"), dates.month_start(d).alias("mes"), dates.week_start(d).alias("semana"), F.col("o_custkey").alias("agency"),
        F.col("o_orderkey").alias("tx"), F.col("o_orderstatus").alias("st"), F.col("o_orderpriority").alias("pm"),
        money(F.col("o_totalprice").cast("decimal(15,2)")).alias("gb"),
    )


B = f"""(select cast(o_orderdate as date) as d, {MONTH.format('o_orderdate')} as mes, {WEEK.format('o_orderdate')} as semana, o_custkey as agency,
  o_orderkey as tx, o_orderstatus as st, o_orderpriority as pm, cast(o_totalprice as decimal(15,2)) as gb from orders)"""

# Filters and projections ----------------------------------------------------------------------------------------------

add(
    "predicates",
    role(
        lambda t, s: t.sales.groupBy("partition_period").agg(
            F.count(F.when(F.col("channel").isin(*s.channels), 1)).alias("in_channels"),
            F.count(F.when(F.col("channel").startswith(s.channel_prefix), 1)).alias("with_prefix"),
            F.count(F.when(F.col("product").contains("rsi"), 1)).alias("with_text"),
            F.count(F.when(~text.is_test_name("agency_name"), 1)).alias("no_test"),
            F.count(F.when(F.col("gestion_date").between(date(1998, 1, 1), date(1998, 12, 31)), 1)).alias("in_range"),
            F.count(F.when((F.col("gestion_date") >= date(1998, 1, 1)) & (F.col("gestion_date") < AS_OF), 1)).alias("half_open"),
            F.count(F.when(text.filled("origin_product_id"), 1)).alias("filled"),
            F.count(F.when(~F.col("agency_name").isin("Contest Travel"), 1)).alias("not_in"),
        )
    ),
    with_roles(
        "sales",
        f"""select partition_period, count(*) filter (where channel in {members(R.CHANNELS)}) as in_channels,
  count(*) filter (where channel like 'web%') as with_prefix, count(*) filter (where product like '%rsi%') as with_text,
  count(*) filter (where lower(coalesce(agency_name, '')) not like '%test%') as no_test,
  count(*) filter (where gestion_date between date '1998-01-01' and date '1998-12-31') as in_range,
  count(*) filter (where gestion_date >= date '1998-01-01' and gestion_date < {day(AS_OF)}) as half_open,
  count(*) filter (where origin_product_id is not null and origin_product_id <> '') as filled,
  count(*) filter (where agency_name not in ('Contest Travel')) as not_in
from sales group by all""",
    ),
)
add(
    "test_exclusion",
    role(lambda t, s: text.exclude_test(t.transactions, "agency_fantasy_name").groupBy("channel").agg(F.count("*").alias("n"), F.count("agency_fantasy_name").alias("named"))),
    with_roles("transactions", "select channel, count(*) as n, count(agency_fantasy_name) as named from transactions where not contains(lower(coalesce(agency_fantasy_name, '')), 'test') group by all"),
)
add(
    "since_launch",
    role(
        lambda t, s: rollout.since_launch(t.sales.select(F.col("creation_date").alias("d"), F.col("country_code").alias("c"), "gb"), s.link_launches)
        .groupBy("c").agg(F.count("*").alias("n"), F.min("d").alias("first_day"), rounded(F.sum("gb"), 2).alias("gb")),
        R.IMPACT,
    ),
    with_roles(
        "sales",
        f"""select country_code as c, count(*) as n, min(creation_date) as first_day, cast(sum(gb) as double) as gb from sales
where creation_date >= {launches(R.IMPACT.link_launches, 'country_code')} group by all""",
    ),
)
add(
    "prefix_strip",
    role(lambda t, s: t.requests.groupBy(text.strip_prefix("created_user", fixed.STAFF_PREFIX, 5).alias("person")).agg(F.count("*").alias("n"))),
    with_roles("requests", "select replace(created_user, 'ext.', '') as person, count(*) as n from requests group by all"),
)
add(
    "payment_class",
    role(
        lambda t, s: t.products.withColumn("creation_date", F.date_sub("penalty_start_date", 5)).groupBy(initiatives.mix_class(s).alias("g")).agg(F.count("*").alias("n")),
        R.IMPACT,
    ),
    with_roles(
        "products",
        "select case when contains(payment_methods, 'REMOTE') then if(penalty_start_date is null, "
        f"'{fixed.LINK_OLD}', '{fixed.LINK_NEW}') "
        + " ".join(f"when contains(payment_methods, '{k}') then '{v}'" for k, v in fixed.MIX_LABELS)
        + " else 'Otros' end as g, count(*) as n from products group by all",
    ),
)
add(
    "fare_class",
    role(lambda t, s: initiatives.hotel_sales(t, s, min(s.link_launches.values())).groupBy("c", initiatives.fare_class().alias("cls")).agg(F.count("*").alias("n")), R.IMPACT),
    with_roles(
        "sales,products",
        f"""select country_code as c, case when not refundable and contains(payment_methods, 'REMOTE') and penalty_start_date >= creation_date
    and creation_date >= {launches(R.IMPACT.link_launches, 'country_code')} then 'L' when not refundable then 'N' when refundable then 'R' else 'X' end as cls,
  count(*) as n
from sales left join products on transaction_id = origin_product_id where channel in {members(R.CHANNELS)}
  and creation_date >= {day(min(R.IMPACT.link_launches.values()))} and product = 'Hoteles' and country_code in {members(R.IMPACT.link_launches)}
  and not contains(lower(coalesce(agency_name, '')), 'test') group by all""",
    ),
)
add(
    "product_groups",
    role(
        lambda t, s: t.sales.groupBy(
            initiatives.product_group().alias("g"), text.recode("transaction_status", fixed.STATUS_CODES).alias("st"),
            first_half.revenue_country().alias("pais"), first_half.revenue_product().alias("producto"),
        ).agg(F.count("*").alias("n"))
    ),
    with_roles(
        "sales",
        "select case product " + " ".join(f"when '{k}' then '{v}'" for k, v in fixed.PROMISE_GROUPS.items())
        + " else 'OT' end as g, case transaction_status when 'Confirmado' then 'C' when 'Activo' then 'A' when 'Cancelado' then 'X' end as st, "
        f"if(country_code in {members(fixed.REVENUE_COUNTRIES)}, country_code, 'O') as pais, case when buy_type_code in ('Bundles', 'Carrito') then 'Paquetes' "
        "when buy_type_code in ('Actividades', 'Traslados') then 'Dest. Serv' else buy_type_code end as producto, count(*) as n from sales group by all",
    ),
)
add(
    "cancel_reasons",
    role(lambda t, s: t.products.withColumn("cr", F.col("cancellation_reason")).groupBy(initiatives.cancel_reason().alias("r")).agg(F.count("*").alias("n"))),
    with_roles(
        "products",
        "select case cancellation_reason when 'AGENCY_CANCELED' then 'Cancela la agencia' when 'TIMEOUT_48' then 'Vence sin pago' "
        "when 'BOOKING_ERROR' then 'Error de reserva' else 'Otros' end as r, count(*) as n from products group by all",
    ),
)
add(
    "next_period",
    over("orders", lambda o: o.select(dates.yyyymm(F.to_date("o_orderdate")).alias("mes")).groupBy("mes", dates.next_yyyymm("mes").alias("next"), dates.previous_yyyymm("mes").alias("previous")).agg(F.count("*").alias("n"))),
    f"""select cast(strftime(m, '%Y%m') as int) as mes, cast(strftime(m + interval 1 month, '%Y%m') as int) as next,
  cast(strftime(m - interval 1 month, '%Y%m') as int) as previous, count(*) as n from (select {MONTH.format('o_orderdate')} as m from orders) group by all""",
)
add(
    "adjusted_revenue",
    role(lambda t, s: first_half.revenue_lines(t, s, s.revenue_from).groupBy("country_code").agg(F.count("*").alias("n"), rounded(F.sum("net_revenue"), 2).alias("rev"))),
    with_roles(
        "sales,profit,transactions",
        f"""select country_code, count(*) as n, cast(round(sum(case when country_code = 'BR' and product <> 'Vuelos' then (net_revenues_usd - affiliates_usd) * 0.92
    when country_code = 'MX' then net_revenues_usd * 0.85 when country_code = 'CO' then net_revenues_usd * 0.84
    when country_code in ('CL', 'BR') then net_revenues_usd * 0.92 when country_code in ('US', 'PA') then net_revenues_usd * 0.80
    else net_revenues_usd * 0.97 end), 2) as double) as rev
from sales join profit p using (product_id) join transactions t on t.transaction_code = cast(p.transaction_code as varchar)
where gestion_date >= {day(R.FIRST.revenue_from)} and partition_period >= '1998-01' and lob_gestion in ('line-O', 'line-F')
  and sales.parent_channel = 'Agencias afiliadas' and p.line_of_business = 'B2B' and date_reservation_year_month >= '1998-01'
  and reservation_year_month >= {day(R.FIRST.revenue_from)} group by all""",
    ),
)
add(
    "sheet_targets",
    role(lambda t, s: first_half.revenue_targets(t).withColumn("net_revenue_target", F.col("net_revenue_target").cast("double"))),
    with_roles(
        "forecast,budget",
        "select source, if(length(y) = 2, 2000 + cast(y as int), cast(y as int)) as year, cast(no_mes_proyectado as int) as month, case producto "
        + " ".join(f"when '{k}' then '{v}'" for k, v in fixed.SHEET_PRODUCTS.items()) + " end as producto, coalesce(case pais "
        + " ".join(f"when '{k}' then '{v}'" for k, v in fixed.SHEET_COUNTRIES.items())
        + " end, 'O') as pais, cast(sum(cast(net_revenue as decimal(15,6))) as double) as net_revenue_target from ("
        "select 'FCST' as source, split_part(fecha, '/', 3) as y, * from forecast union all select 'BDGT', split_part(fecha, '-', 3), * from budget) "
        "where lob_canal = 'B2B-MIN' group by all",
    ),
)

add(
    "repeated_side_keys",
    role(lambda t, s: repeated_side_keys(t)),
    with_roles(
        "corrections,marketing_funds,marketing_funds_2",
        " union all ".join(
            f"select '{r}' as role, product_id, count(*) as n from {r} group by all having count(*) > 1" for r in ("corrections", "marketing_funds", "marketing_funds_2")
        ),
    ),
)

# Joins ----------------------------------------------------------------------------------------------------------------

add(
    "skew_join",
    lambda spark, sf_dir: joins.skew_join(
        spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("k"), "l_suppkey", "l_extendedprice"),
        spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"), "o_orderpriority"),
        "k", "left", rows_per_part=100,
    ).groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).cast("double").alias("v")),
    "select o_orderpriority, count(*) as n, cast(sum(cast(l_extendedprice as decimal(15,2))) as double) as v from lineitem left join orders on l_orderkey = o_orderkey group by all",
)
add(
    "semi_join",
    lambda spark, sf_dir: joins.skew_join(
        spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("k"), "o_orderkey", "o_orderstatus"),
        spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k")),
        "k", "left_semi", rows_per_part=100,
    ).groupBy("o_orderstatus").agg(F.count("*").alias("n")),
    "select o_orderstatus, count(*) as n from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING') group by all",
)
add(
    "flag_join",
    role(
        lambda t, s: joins.flag_join(
            t.reservations.select(F.col("oid").alias("k"), "country_code", "id"), t.deferred.select(F.col("reservation_id").alias("k")), "k", "promised"
        ).groupBy("country_code", "promised").agg(F.count("*").alias("n"))
    ),
    with_roles("reservations,deferred", "select country_code, if(oid in (select reservation_id from deferred), 1, 0) as promised, count(*) as n from reservations group by all"),
)
add(
    "spine_join",
    lambda spark, sf_dir: joins.on_spine(
        spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").alias("k"), "n_name"),
        spark.read.parquet(f"{sf_dir}/customer.parquet").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n")).where("n % 3 <> 0"),
        "k", zero=["n"],
    ).select("n_name", "n"),
    "select n_name, if(count(c_custkey) % 3 = 0, 0, count(c_custkey)) as n from nation left join customer on c_nationkey = n_nationkey group by n_name",
)
add(
    "paired_periods",
    over("orders", lambda o: cohort.booking_pairs(
        o.select(dates.yyyymm(F.to_date("o_orderdate")).alias("mes"), F.col("o_custkey").alias("partner_id"))
        .groupBy("mes", "partner_id").agg(F.count("*").alias("reservas"))
    ).groupBy("mes_evaluacion").agg(F.sum("prev_n").alias("before"), F.sum("cur_n").alias("now"), F.count(F.col("prev_n") + F.col("cur_n")).alias("both"))),
    """with m as (select date_trunc('month', o_orderdate) as m, o_custkey as p, count(*) as n from orders group by all),
x as (select coalesce(c.m, b.m + interval 1 month) as m, b.n as before, c.n as now from m c full join m b on b.p = c.p and b.m + interval 1 month = c.m)
select cast(strftime(m, '%Y%m') as int) as mes_evaluacion, cast(sum(before) as bigint) as before, cast(sum(now) as bigint) as now,
  count(*) filter (where before is not null and now is not null) as "both" from x group by all""",
)
add(
    "promise_status",
    role(lambda t, s: first_half.promise_status(t, s, F.lit(True)).groupBy("status").agg(F.count_distinct("reservation_id").alias("n"), rounded(F.sum("gb"), 2).alias("gb"))),
    with_roles(
        "sales,reservations,cancellations,deferred",
        f"""select if(s.transaction_status = 'Cancelado' and c.type = 'TIMEOUT_CLIENT', 'Time_out_client', r.status) as status, count(distinct r.id) as n,
  cast(sum(gb) as double) as gb
from reservations r join deferred d on d.reservation_id = r.oid left join cancellations c on c.reservation_id = r.oid
  left join (from sales where partition_period >= '{R.FIRST.promise_sales_from}' and channel in {members(R.CHANNELS)}) s on s.transaction_code = cast(r.id as bigint)
where last_version and r.channel like 'web%' and reason = 'PROMISE-B2B' and deadline is not null group by all""",
    ),
)

# Aggregates -----------------------------------------------------------------------------------------------------------

add(
    "conditional_counts",
    over("orders", lambda o: aggregate.entity_counts(
        bookings(o), ["mes"],
        {"agencies": ("agency", None), "confirmed": ("agency", F.col("st") == "F"), "urgent": ("agency", F.col("pm") == "1-URGENT"), "bookings": ("tx", F.col("st") == "F")},
        {"gb": F.when(F.col("st") == "P", F.col("gb"))}, {"last_day": F.col("d")}, {"again": ("agency", F.col("st") == "F", 2)},
    ).withColumn("gb", rounded("gb", 2))),
    f"""select mes, count(distinct agency) as agencies, count(distinct agency) filter (where st = 'F') as confirmed,
  count(distinct agency) filter (where pm = '1-URGENT') as urgent, count(distinct tx) filter (where st = 'F') as bookings,
  cast(sum(gb) filter (where st = 'P') as double) as gb, max(d) as last_day,
  (select count(*) from (select agency from {B} y where y.mes = x.mes and st = 'F' group by agency having count(distinct tx) >= 2)) as again
from {B} x group by mes""",
)
add(
    "subtotals",
    over("customer", lambda c: aggregate.keep_total_rows(
        aggregate.entity_counts(
            c.select(F.col("c_mktsegment").alias("c"), "c_nationkey", "c_acctbal"), ["c"],
            {"nations": ("c_nationkey", None)}, {"balance": F.col("c_acctbal").cast("decimal(15,2)")}, totals=("c", {"ALL": None}),
        ), "c", ["ALL", "NONE"], ["nations"],
    ).withColumn("balance", rounded("balance", 2))),
    """select c_mktsegment as c, count(distinct c_nationkey) as nations, cast(sum(cast(c_acctbal as decimal(15,2))) as double) as balance from customer group by 1
union all select 'ALL', count(distinct c_nationkey), cast(sum(cast(c_acctbal as decimal(15,2))) as double) from customer
union all select 'NONE', 0, null""",
)
add(
    "repeat_buyers",
    over("orders", lambda o: aggregate.repeaters(bookings(o), ["mes"], "agency", "tx", 2, "again")),
    f"select mes, count(*) filter (where n >= 2) as again from (select mes, agency, count(distinct tx) as n from {B} group by all) group by mes",
)
add(
    "top_customers",
    over("orders", lambda o: aggregate.top_k(
        o.groupBy("o_custkey").agg(F.count("*").alias("n"), rounded(F.sum(F.col("o_totalprice").cast("decimal(15,2)")), 2).alias("g")), "g", 10, "o_custkey"
    )),
    "select o_custkey, count(*) as n, cast(sum(cast(o_totalprice as decimal(15,2))) as double) as g from orders group by o_custkey order by g desc, o_custkey limit 10",
)
add(
    "ordered_text",
    over("orders", lambda o: aggregate.packed_list(
        o.groupBy(F.year("o_orderdate").alias("y"), "o_orderpriority").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("a")),
        ["y"], "o_orderpriority", ["n", "a"], "n",
    )),
    """select y, string_agg(p || ' ' || n || ' ' || a, ';' order by n desc, p) as s
from (select year(o_orderdate) as y, o_orderpriority as p, count(*) as n, count(distinct o_custkey) as a from orders group by all) group by y""",
)
add(
    "member_list",
    over("lineitem", lambda l: l.groupBy("l_orderkey").agg(aggregate.member_list("l_returnflag", "R").alias("others")).groupBy("others").agg(F.count("*").alias("n"))),
    """select others, count(*) as n from (
  select coalesce(string_agg(distinct l_returnflag, '+' order by l_returnflag) filter (where l_returnflag <> 'R'), '') as others from lineitem group by l_orderkey)
group by others""",
)
add(
    "weighted_mean",
    over("customer", lambda c: c.groupBy("c_mktsegment").agg(
        F.round(aggregate.weighted_mean(F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")), F.col("c_nationkey") + 1), 6).alias("mean")
    )),
    """select c_mktsegment, round(sum(c_acctbal * (c_nationkey + 1)) filter (where c_acctbal > 0) / sum(c_nationkey + 1) filter (where c_acctbal > 0), 6) as mean
from customer group by all""",
)


def monthly_values(o):
    return o.groupBy(F.col("o_orderpriority").alias("id"), dates.week_start(F.to_date("o_orderdate")).alias("semana")).agg(
        F.count("*").cast("double").alias("value")
    )


MV = f"(select o_orderpriority as id, {WEEK.format('o_orderdate')} as semana, cast(count(*) as double) as value from orders group by all)"
add("extreme_weeks", over("orders", lambda o: aggregate.extreme_row(monthly_values(o), ["id"], "value", "semana")),
    f"select id, max(value) as value, arg_min(semana, (-value, semana)) as semana from {MV} group by id")
add("last_weeks", over("orders", lambda o: aggregate.last_row(monthly_values(o), ["id"], "value", "semana")),
    f"select id, arg_max(value, semana) as value, max(semana) as semana from {MV} group by id")
add("mean_without_latest", over("orders", lambda o: cumulative.mean_without_latest(monthly_values(o), "id", "semana", "value").withColumn("mean_complete", F.round("mean_complete", 6))),
    f"select id, round(avg(value) filter (where semana < last), 6) as mean_complete from (select *, max(semana) over (partition by id) as last from {MV}) group by id")
add(
    "worsening",
    over("orders", lambda o: cumulative.worsening(monthly_values(o), "id", "semana", "value", F.col("id") > "3")),
    f"""with r as (select id, id > '3' as inv, value as last, lag(value) over w as prev, lag(value, 2) over w as prev2,
    row_number() over (partition by id order by semana desc) as k from {MV} window w as (partition by id order by semana))
select id, inv, last, prev, if(inv, last < prev, last > prev) as up, coalesce(if(inv, last > prev and prev > prev2, last < prev and prev < prev2), false) as declining
from r where k = 1""",
)


def lines_of_weeks(o):
    """Orders per week and priority, numbered from 1998-01-05 in both directions."""
    start = date(1998, 1, 5)
    rows = o.select(F.col("o_orderpriority").alias("p"), dates.block_index(F.to_date("o_orderdate"), F.lit(start)).alias("b"))
    return rows.groupBy("p", "b").agg(F.count("*").cast("double").alias("v"))


add(
    "least_squares",
    over("orders", lambda o: aggregate.least_squares(lines_of_weeks(o), ["p"], "b", "v").groupBy("p").agg(
        *[F.round(F.max(c), 6).alias(c) for c in ("intercept", "slope", "sd", "mean_x", "sxx")], F.max("n").alias("n")
    )),
    """with v as (select p, b, cast(count(*) as double) as v from (
  select o_orderpriority as p, cast(floor((cast(o_orderdate as date) - date '1998-01-05') / 7) as int) as b from orders) group by all)
select p, round(regr_intercept(v, b), 6) as intercept, round(regr_slope(v, b), 6) as slope, round(regr_avgx(v, b), 6) as mean_x, round(regr_sxx(v, b), 6) as sxx,
  cast(regr_count(v, b) as bigint) as n, round(sqrt((regr_syy(v, b) - regr_sxy(v, b) * regr_sxy(v, b) / regr_sxx(v, b)) / (count(*) - 2)), 6) as sd from v group by p""",
)
add(
    "last_step",
    over("orders", lambda o: calendar.last_step(
        o.groupBy(dates.year_month("o_orderdate").alias("mes"), F.dayofmonth("o_orderdate").alias("dia")).agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("a")),
        "mes", "dia", ["n", "a"],
    )),
    """select mes, dia, n, a from (select strftime(o_orderdate, '%Y-%m') as mes, day(o_orderdate) as dia, count(*) as n, count(distinct o_custkey) as a from orders group by all)
qualify row_number() over (partition by mes order by dia desc) = 1""",
)

# Cumulative figures ---------------------------------------------------------------------------------------------------


def spine_sql(select: str, group: str) -> str:
    return f"""with e as (select * from {B}), spine as (select distinct mes, semana from e)
select {select} from spine s join e on e.mes = s.mes and e.semana <= s.semana group by {group}"""


FLAGGED = "count(distinct agency) filter (where st = 'F')"
add(
    "cumulative_distinct",
    over("orders", lambda o: cumulative.cumulative_distinct(bookings(o), "mes", "semana", "agency", {"confirmed": F.col("st") == "F"}).drop("in_step")),
    spine_sql(f"s.mes, s.semana, count(distinct agency) as cumulative, {FLAGGED} as cumulative_confirmed", "s.mes, s.semana"),
)
add(
    "cumulative_distinct_by_week",
    over("orders", lambda o: cumulative.cumulative_distinct(bookings(o), "mes", "semana", "agency", {"confirmed": F.col("st") == "F"}, by="step")),
    spine_sql(f"s.semana, count(distinct agency) as cumulative, {FLAGGED} as cumulative_confirmed", "s.semana"),
)
add(
    "cumulative_sum",
    over("orders", lambda o: cumulative.cumulative_sum(bookings(o), "mes", "semana", "gb").select("mes", "semana", rounded("cumulative", 2).alias("gb"))),
    spine_sql("s.mes, s.semana, cast(sum(gb) as double) as gb", "s.mes, s.semana"),
)
add(
    "cumulative_sum_by_week",
    over("orders", lambda o: cumulative.cumulative_sum(bookings(o), "mes", "semana", "gb", by="step").select("semana", rounded("cumulative", 2).alias("gb"))),
    spine_sql("s.semana, cast(sum(gb) as double) as gb", "s.semana"),
)
add(
    "cumulative_rate",
    over("orders", lambda o: cumulative.cumulative_distinct(bookings(o), "mes", "semana", "agency", {"confirmed": F.col("st") == "F"}).select("mes", "semana", pct_column("cumulative_confirmed", "cumulative").alias("rate"))),
    spine_sql(f"s.mes, s.semana, {pct(FLAGGED, 'count(distinct agency)')} as rate", "s.mes, s.semana"),
)
add(
    "step_values",
    over("orders", lambda o: cumulative.step_values(cumulative.cumulative_distinct(bookings(o), "mes", "semana", "agency"), "mes", "semana", ["cumulative"]).select("mes", "semana", F.col("cumulative").alias("new_agencies"))),
    f"""select mes, semana, count(*) filter (where first = semana) as new_agencies from (
  select *, min(semana) over (partition by mes, agency) as first from (select distinct mes, semana, agency from {B})) group by all""",
)
add(
    "activation_rate",
    over("events", lambda e: cohort.activation(
        e.where("event_type = 'click'").select(F.to_date("ts").alias("d"), "user_id"), e.where("event_type = 'purchase'").select(F.to_date("ts").alias("d"), "user_id"), "d", "user_id"
    )),
    f"""with c as (select cast(ts as date) as d, user_id as u, count(*) as n from events where event_type = 'click' group by all),
p as (select distinct cast(ts as date) as d, user_id as u from events where event_type = 'purchase')
select c.d, count(*) as quoting, count(p.u) as converted, cast(sum(n) as bigint) as quotes, {pct('count(p.u)', 'count(*)')} as pct
from c left join p on p.d = c.d and p.u = c.u group by c.d""",
)

# Calendar -------------------------------------------------------------------------------------------------------------

H2 = R.SECOND
add(
    "commercial_weeks",
    lambda spark, sf_dir: joins.on_spine(
        calendar.expand_calendar(calendar.commercial_calendar(spark, H2.calendar), H2.as_of),
        calendar.asof_state(
            spark.read.parquet(f"{sf_dir}/orders.parquet").select(
                F.col("o_custkey").alias("agencia_id"), F.to_date("o_orderdate").alias("rd"), F.to_date("o_orderdate").alias("cd"),
                F.when(F.col("o_orderstatus") == "P", F.date_add(F.to_date("o_orderdate"), 10)).alias("xd"),
            ),
            calendar.expand_calendar(calendar.commercial_calendar(spark, H2.calendar), H2.as_of),
        ).groupBy("periodo", "semana").agg(F.count("*").alias("orders"), F.sum("conf").alias("confirmed"), F.sum("viva").alias("alive"), F.max("w").alias("w")),
        ["periodo", "semana"], zero=["orders", "confirmed", "alive"],
    ),
    f"""with cal as (select * from (values {", ".join(f"('{p}', {day(a)}, {day(b)}, {n})" for p, a, b, n in H2.calendar)}) c(periodo, desde, hasta, n_sem)),
wk as (select *, cast(unnest(range(1, n_sem + 1)) as int) as k from cal)
select periodo, n_sem, desde as m_desde, k as semana, desde + 7 * k - 7 as s_desde, desde + 7 * k - 1 as s_hasta, least(desde + 7 * k, {day(H2.as_of)}) as foto,
  if(desde + 7 * k <= {day(H2.as_of)}, 'CIERRE', 'EN_CURSO') as estado, count(o.d) as orders,
  count(*) filter (where o.d <= least(desde + 7 * k, {day(H2.as_of)}) and (st <> 'P' or o.d + 10 > least(desde + 7 * k, {day(H2.as_of)}))) as confirmed,
  count(*) filter (where o.d is not null and (st <> 'P' or o.d + 10 > least(desde + 7 * k, {day(H2.as_of)}))) as alive, cast(max((o.d - desde) // 7 + 1) as int) as w
from wk left join {B} o on o.d between desde and desde + 7 * k - 1 where desde + 7 * k - 7 <= {day(H2.as_of)} group by all""",
)
add(
    "frequent_buyers",
    role(lambda t, s: calendar.frequent_buyers(second_half.order_states(t, s)[1]), H2),
    with_roles(
        "transactions",
        f"""with cal as (select * from (values {", ".join(f"('{p}', {day(a)}, {n})" for p, a, _, n in H2.calendar)}) c(periodo, desde, n_sem)),
wk as (select periodo, desde, k as semana, least(desde + 7 * k, {day(H2.as_of)}) as foto from (select *, cast(unnest(range(1, n_sem + 1)) as int) as k from cal) where desde + 7 * k - 7 <= {day(H2.as_of)}),
s as (
  select periodo, semana, regexp_replace(partner_data_id, '^WLAG', 'AG') as a, (reservation_date - desde) // 7 + 1 as w,
    cancelation_date is null or cancelation_date > foto as alive, coalesce(confirmation_date <= foto, false) as done
  from wk join transactions on reservation_date between desde and desde + 7 * semana - 1
  where reservation_year_month is not null and parent_channel = 'Agencias afiliadas' and line_of_business = 'B2B'),
g as (select periodo, semana, a, count(distinct w) filter (where alive and done) as c, count(distinct w) filter (where alive) as v,
    bool_or(alive and done and w = semana) as now from s group by all)
select periodo, semana, count(*) filter (where c >= 3) as frecuentes_conf, count(*) filter (where v >= 3) as frecuentes_vivas,
  count(*) filter (where c >= 1) as compradoras_conf, count(*) filter (where v >= 1) as compradoras_vivas, count(*) filter (where now) as compradoras_semana
from g group by all""",
    ),
)
ANCHOR = date(1999, 1, 1)
add(
    "closed_weeks",
    lambda spark, sf_dir: joins.on_spine(
        calendar.closed_periods(spark, ANCHOR, AS_OF, 7, 1),
        spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy(calendar.period_of(F.to_date("o_orderdate"), ANCHOR).alias("week_start")).agg(F.count("*").alias("n")),
        "week_start", zero=["n"],
    ),
    f"""select w as week_start, count(o.d) as n from (select cast(unnest(generate_series({day(ANCHOR)}, {day(AS_OF)}, interval 7 days)) as date) as w) x
  left join {B} o on o.d between w and w + 6 where w + 7 <= {day(AS_OF)} group by w""",
)


def stored_weeks(o):
    """Weeks with a number of orders that three does not divide, as a store with gaps."""
    weeks = o.groupBy(calendar.period_of(F.to_date("o_orderdate"), ANCHOR).alias("week_start")).agg(F.count("*").alias("n"))
    return weeks.where("n % 3 <> 0")


STORED = f"select {day(ANCHOR)} + 7 * cast(floor((d - {day(ANCHOR)}) / 7) as int) as w from {B} group by w having count(*) % 3 <> 0"
CLOSED = f"select cast(unnest(generate_series({day(ANCHOR)}, {day(AS_OF - timedelta(days=7))}, interval 7 days)) as date) as w"
add("missing_weeks", over("orders", lambda o: calendar.missing_periods(calendar.closed_periods(o.sparkSession, ANCHOR, AS_OF, 7, 1), stored_weeks(o))),
    f"select w as week_start from ({CLOSED}) where w not in ({STORED})")
add("weeks_to_fetch", over("orders", lambda o: calendar.periods_to_fetch(calendar.closed_periods(o.sparkSession, ANCHOR, AS_OF, 7, 1), stored_weeks(o), 3)),
    f"with c as ({CLOSED}) select w as week_start from c where w not in ({STORED}) or w in (select w from c order by w desc limit 3)")
add(
    "block_counts",
    role(
        lambda t, s: rollout.with_blocks(rollout.with_launch(t.sales.select(F.col("country_code").alias("c"), F.col("creation_date").alias("d")), s.link_launches), s.as_of)
        .groupBy("c", "b").agg(F.count("*").alias("n"), F.min("d").alias("first_day")),
        R.IMPACT,
    ),
    with_roles(
        "sales",
        f"""select c, b, count(*) as n, min(d) as first_day from (
  select *, cast(floor((d - ld) / 7) as int) as b from (select country_code as c, creation_date as d, {launches(R.IMPACT.link_launches, 'country_code')} as ld from sales))
where ld + 7 * (b + 1) <= {day(R.IMPACT.as_of)} group by all""",
    ),
)
PRE_DAYS, PRE_FROM = calendar.symmetric_window(R.IMPACT.promise_launch, R.IMPACT.as_of)
add(
    "symmetric_window",
    over("orders", lambda o: bookings(o).where((F.col("d") >= F.lit(PRE_FROM)) & (F.col("d") < F.lit(R.IMPACT.as_of)))
         .groupBy((F.col("d") >= F.lit(R.IMPACT.promise_launch)).alias("after"))
         .agg(F.count_distinct("d").alias("days"), F.count("*").alias("n"), F.min("d").alias("first_day"), F.max("d").alias("last_day"))),
    f"""select d >= {day(R.IMPACT.promise_launch)} as after, count(distinct d) as days, count(*) as n, min(d) as first_day, max(d) as last_day from {B}
where d >= {day(R.IMPACT.promise_launch)} - {PRE_DAYS} and d < {day(R.IMPACT.as_of)} group by all""",
)
add(
    "grain_visitors",
    over("events", lambda e: calendar.by_grains(e.select(F.to_date("ts").alias("day"), "user_id").distinct(), "day").select("grain", "p", "user_id").distinct()
         .groupBy("grain", "p").agg(F.count("*").alias("users"))),
    """select 'd' as grain, strftime(ts, '%Y-%m-%d') as p, count(distinct user_id) as users from events group by all
union all select 'w', strftime(date_trunc('week', ts), '%Y-%m-%d'), count(distinct user_id) from events group by all
union all select 'm', strftime(ts, '%Y-%m'), count(distinct user_id) from events group by all
union all select 't', 'total', count(distinct user_id) from events""",
)
add(
    "weeks_in_month",
    over("orders", lambda o: bookings(o).select("semana", "mes").distinct().groupBy("mes").agg(F.count("*").alias("weeks"))),
    f"select mes, count(distinct semana) as weeks from {B} group by mes",
)

# Events ---------------------------------------------------------------------------------------------------------------

add(
    "filter_clicks",
    lambda spark, sf_dir: usability.filter_clicks(R.roles(spark, sf_dir), R.USAGE_FROM, R.USAGE_TO),
    with_roles("used_filters", f"select distinct source, d, pageview_id, name as filter_name from used_filters where d between {day(R.USAGE_FROM)} and {day(R.USAGE_TO)}"),
)
add(
    "clean_pages",
    role(lambda t, s: clean_pages(t.traffic, s.channels).groupBy("product", "flow").agg(F.count("*").alias("n"), F.count_distinct("visit").alias("visits")), R.CLICKS),
    with_roles("traffic", f"select product, flow, count(*) as n, count(distinct visit) as visits from traffic where ispageview = 1 and flg_detalle_cp + is_bot = 0 and channel in {members(R.CHANNELS)} group by all"),
)

# Stores ---------------------------------------------------------------------------------------------------------------


def weekly_store(o):
    return o.groupBy(calendar.period_of(F.to_date("o_orderdate"), ANCHOR).alias("week_start"), F.col("o_orderpriority").alias("product"), F.col("o_orderstatus").alias("country")).agg(
        F.count("*").alias("visits"), F.count_distinct("o_custkey").alias("clicks"), F.max("o_custkey").alias("thanks")
    )


WS = f"""(select {day(ANCHOR)} + 7 * cast(floor((d - {day(ANCHOR)}) / 7) as int) as week_start, pm as product, st as country, count(*) as visits,
  count(distinct agency) as clicks, max(agency) as thanks from {B} group by all)"""
add(
    "upsert_weeks",
    over("orders", lambda o: snapshots.upsert_weeks(
        weekly_store(o), weekly_store(o).where("country <> 'P'").withColumn("visits", F.col("visits") + 1).join(stored_weeks(o), "week_start", "left_semi")
    )),
    f"""with new as (select * replace (visits + 1 as visits) from {WS} where country <> 'P' and week_start in (select w from ({STORED})))
select * from {WS} where week_start not in (select week_start from new) union all select * from new""",
)
add("retain_weeks", over("orders", lambda o: snapshots.retain_last(weekly_store(o), 26)),
    f"select * from {WS} qualify dense_rank() over (order by week_start desc) <= 26")
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
add(
    "zero_filled_weeks",
    over("orders", lambda o: snapshots.zero_filled(weekly_store(o), PRIORITIES, ["F", "O", "P", "X"])),
    f"""with s as (select * from {WS})
select w.week_start, p.product, c.country, coalesce(visits, 0) as visits, coalesce(clicks, 0) as clicks, coalesce(thanks, 0) as thanks
from (select distinct week_start from s) w, (select unnest({PRIORITIES}) as product) p, (select unnest(['F', 'O', 'P', 'X']) as country) c
  left join s on s.week_start = w.week_start and s.product = p.product and s.country = c.country""",
)
add(
    "json_rows",
    over("orders", lambda o: snapshots.json_native(
        o.groupBy(dates.month_start(F.to_date("o_orderdate")).alias("mes"), "o_orderstatus").agg(
            F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("gb"), F.max(F.when(F.col("o_custkey") % 90 == 0, F.col("o_custkey"))).alias("c")
        ), zero_nulls=True,
    )),
    f"select strftime(mes, '%Y-%m-%d') as mes, st as o_orderstatus, cast(sum(gb) as double) as gb, coalesce(max(agency) filter (where agency % 90 = 0), 0) as c from {B} group by all",
)



def refreshed_snapshot(spark, sf_dir):
    """Three metrics, of which one is then refreshed and one falls to nothing; read back by key."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    path = scratch_path(spark, "snapshot")
    status, priority = (orders.groupBy(F.col(c).alias("k")).agg(F.count("*").alias("n")) for c in ("o_orderstatus", "o_orderpriority"))
    snapshots.write_snapshot({"status": status, "priority": priority, "gone": status}, path)
    later = priority.withColumn("n", F.col("n") + 1)
    snapshots.refresh_snapshot({"priority": later, "gone": status.where("n < 0")}, path)
    parts = [snapshots.read_snapshot(spark, path, key).withColumn("metric", F.lit(key)) for key in ("status", "priority", "gone")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


add(
    "snapshot_refresh",
    refreshed_snapshot,
    """select o_orderstatus as k, count(*) as n, 'status' as metric from orders group by all
union all select o_orderpriority, count(*) + 1, 'priority' from orders group by all""",
)


def isolated_failures(spark, sf_dir):
    """A full build of three metrics, and a second one in which two fail: one by its plan, one while it runs."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    path = scratch_path(spark, "build")
    counts = {c: orders.groupBy(F.col(c).alias("k")).agg(F.count("*").alias("n")) for c in ("o_orderstatus", "o_orderpriority", "o_custkey")}
    snapshots.write_each({c: (lambda df=df: df) for c, df in counts.items()}, path)
    status = snapshots.write_each({
        "o_orderstatus": lambda: counts["o_orderstatus"].withColumn("n", F.col("n") + 1),
        "o_orderpriority": lambda: counts["o_orderpriority"].select("absent"),
        "o_custkey": lambda: counts["o_custkey"].withColumn("n", F.raise_error(F.lit("late")).cast("long")),
    }, path)
    parts = [
        snapshots.read_snapshot(spark, path, c).groupBy().agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
        .select(F.lit(c).alias("metric"), F.lit(status[c] == "ok").alias("fine"), "rows", "n")
        for c in counts
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


add(
    "failure_isolation",
    isolated_failures,
    """select 'o_orderstatus' as metric, true as fine, count(distinct o_orderstatus) as rows, cast(count(*) + count(distinct o_orderstatus) as bigint) as n from orders
union all select 'o_orderpriority', false, 0, null union all select 'o_custkey', false, 0, null""",
)


def cadences(spark, sf_dir):
    """The monthly group, the weekly one beside it, and the monthly one again on a later day: rows and agencies of each key."""
    path, tables = scratch_path(spark, "cadences"), R.roles(spark, sf_dir)
    registry.refresh("mensual", tables, replace(R.SECOND, as_of=R.SECOND.as_of - timedelta(days=40)), path)
    registry.refresh("semanal", tables, R.SECOND, path)
    registry.refresh("mensual", tables, R.SECOND, path)
    parts = []
    for key in snapshots.snapshot_keys(spark, path):
        rows = snapshots.read_snapshot(spark, path, key)
        total = F.sum("agencias_cotizadoras") if key == "kr21" else F.lit(None).cast("long")
        parts.append(rows.groupBy().agg(F.count("*").alias("rows"), total.alias("agencies")).withColumn("metric", F.lit(key)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


add(
    "cadence_refresh",
    cadences,
    " union all ".join(
        f"""select '{key}' as metric, count(*) as rows, {'cast(sum(agencias_cotizadoras) as bigint)' if key == 'kr21' else 'null::bigint'} as agencies
from ({SECOND[key]})""" for key in ("kr11", "kr21", "kr22", "kr21_sem", "kr22_sem")
    ),
)


def refreshed_weeks(spark, sf_dir):
    """The usage store after a first refresh, a second one that finds one more week, and a recomputation."""
    path, tables = scratch_path(spark, "weeks"), R.roles(spark, sf_dir)
    weekly.refresh(spark, tables, replace(R.CLICKS, as_of=date(2024, 1, 20)), path)
    weekly.refresh(spark, tables, R.CLICKS, path)
    weekly.refresh(spark, tables, R.CLICKS, path, recompute=1)
    return weekly.current(spark, path)


def late_rows(spark, sf_dir):
    """A store that lacked a third of one old week's page views, after the refresh that finds them by their marks."""
    path, tables = scratch_path(spark, "weeks"), R.roles(spark, sf_dir)
    late = F.col("date").between("2024-01-05", "2024-01-11") & (F.xxhash64("visit") % 3 == 0)
    early = Tables(lambda role: tables.traffic.where(~late) if role == "traffic" else getattr(tables, role))
    weekly.refresh(spark, early, R.CLICKS, path, changed=True)
    weekly.refresh(spark, tables, R.CLICKS, path, changed=True)
    return weekly.current(spark, path)


STORED_WEEKS = with_roles(
    USAGE_ROLES,
    f"""{USAGE}, spine as (
  select * from (select unnest([{', '.join(day(d) for d in (date(2024, 1, 5), date(2024, 1, 12), date(2024, 1, 19)))}]) as week_start) w,
    (select unnest([{', '.join(repr(p) for p in weekly.PRODUCTS)}]) as product) p, (select unnest([{', '.join(repr(c) for c in weekly.COUNTRIES)}]) as country) c)
select week_start, product, country, coalesce(visits, 0) as visits, filter_name, coalesce(clicks, 0) as clicks, coalesce(thanks, 0) as thanks
from spine left join usage using (week_start, product, country)""",
)
add("weekly_refresh", refreshed_weeks, STORED_WEEKS)
add("late_rows_refresh", late_rows, STORED_WEEKS)

def in_three_steps(name, settings, until):
    """A running count whose state is brought to the last day in three portions; the second one repeats a week."""
    def run(spark, sf_dir):
        path, tables = scratch_path(spark, "running"), R.roles(spark, sf_dir)
        first = running.running_counts()[name].start(settings)
        third = (until - first) // 3
        running.advance(spark, name, tables, settings, path, first + third)
        running.advance(spark, name, tables, settings, path, first + 2 * third, again_from=first + third - timedelta(days=7))
        running.advance(spark, name, tables, settings, path, until)
        return running.current(spark, name, path)

    return run


add("running_requests", in_three_steps("h1.kr22_sem_cum", R.FIRST, R.MAX_DAY), FIRST["kr22_sem_cum"])
add("running_activation", in_three_steps("h1.kr32_sem_cum", R.FIRST, R.FIRST.weeks_to), FIRST["kr32_sem_cum"])
add("running_quotes", in_three_steps("h2.kr21_sem", R.SECOND, R.SECOND.quoting_to), SECOND["kr21_sem"])

# Scorecard columns and scalar functions -------------------------------------------------------------------------------

add(
    "attainment_bands",
    over("customer", lambda c: c.select("c_custkey", F.when(F.col("c_custkey") % 11 != 0, F.round(F.col("c_acctbal") / 100) + 20).alias("a"), (F.col("c_nationkey") * 4).cast("double").alias("t"), (F.col("c_custkey") % 2 == 0).alias("inv"))
         .withColumn("p", scorecard.attainment("a", "t", "inv"))
         .select("c_custkey", F.round("p", 6).alias("p"), F.round(scorecard.effective("p"), 6).alias("e"), scorecard.band("p").alias("band"), scorecard.band_note("p").alias("note"))),
    """with x as (select c_custkey, if(c_custkey % 11 <> 0, round(c_acctbal / 100) + 20, null) as a, c_nationkey * 4e0 as t, c_custkey % 2 = 0 as inv from customer),
p as (select c_custkey, case when a is null or t = 0 then null when inv and a = 0 then 130e0 when inv then t / a * 100 else a / t * 100 end as p from x),
e as (select *, case when p < 70 then 0e0 when p > 130 then 130e0 else p end as e from p)
select c_custkey, round(p, 6) as p, round(e, 6) as e, case when e is null then 'na' when e >= 100 then 'ok' when e >= 80 then 'warn' else 'bad' end as band,
  case when p < 70 then 'floored' when p > 130 then 'capped' end as note from e""",
)
add(
    "weight_shares",
    over("customer", lambda c: scorecard.weight_shares(c.groupBy(F.col("c_mktsegment").alias("id")).agg(F.min("c_custkey").cast("int").alias("ord"), F.count("*").cast("double").alias("weight")))),
    """with w as (select c_mktsegment as id, cast(min(c_custkey) as int) as ord, count(*) as w from customer group by all),
s as (select id, ord, round(w / sum(w) over () * 100, 1) as s, row_number() over (order by ord desc) = 1 as last from w)
select id, ord, if(last, round(100 - (select sum(s) from s where not last), 1), s) as share from s""",
)
add(
    "weight_shares_plain",
    over("customer", lambda c: scorecard.weight_shares(
        c.groupBy(F.col("c_mktsegment").alias("id")).agg(F.min("c_custkey").cast("int").alias("ord"), F.count(F.when(F.col("c_mktsegment") != "BUILDING", 1)).cast("double").alias("weight")), fill_last=False)),
    """with w as (select c_mktsegment as id, cast(min(c_custkey) as int) as ord, count(*) filter (where c_mktsegment <> 'BUILDING') as w from customer group by all)
select id, ord, if(w > 0, round(w / (select sum(w) from w) * 100, 1), null) as share from w""",
)
add(
    "scalar_functions",
    over("orders", lambda o: o.select(
        "o_orderkey",
        F.upper("o_orderpriority").alias("up"), F.lower("o_orderpriority").alias("low"), F.substring("o_orderpriority", 3, 2).alias("sub"),
        F.col("o_orderpriority").startswith("1-").alias("starts"), F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("part"),
        F.length("o_orderpriority").alias("len"), F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0")).alias("ym"),
        dates.week_start(F.to_date("o_orderdate")).alias("week"), dates.month_start(F.to_date("o_orderdate")).alias("month"),
        F.date_add(F.to_date("o_orderdate"), 6).alias("plus6"), F.date_diff(F.lit(AS_OF), F.to_date("o_orderdate")).alias("days"),
        F.least(F.to_date("o_orderdate"), F.lit(AS_OF)).alias("earlier"), F.round("o_totalprice", 1).alias("r1"),
        F.bround(F.col("o_orderkey") / 2, 0).cast("long").alias("even"), half_even(F.col("o_orderkey") / 2).alias("even2"),
        dates.block_index(F.to_date("o_orderdate"), F.lit(date(1998, 1, 5))).alias("block"),
        F.coalesce(F.nullif(F.col("o_custkey") % 5, F.lit(0)), F.lit(-1)).alias("guard"), F.round(ratio("o_orderkey", F.col("o_custkey") % 3), 6).alias("ratio"),
        F.expr("o_custkey div 7").alias("whole"), F.round(F.sqrt("o_totalprice"), 6).alias("root"),
        dates.iso_day(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("iso"),
        F.element_at(F.create_map(F.lit("1-URGENT"), F.lit("u")), F.col("o_orderpriority")).alias("mapped"),
        F.array_join(F.transform(F.sequence(F.lit(1), (F.col("o_custkey") % 4 + 1).cast("int")), lambda v: v.cast("string")), "+").alias("seq"),
        F.col("o_orderpriority").try_cast("int").alias("junk"),
    )),
    f"""select o_orderkey, upper(o_orderpriority) as up, lower(o_orderpriority) as low, substr(o_orderpriority, 3, 2) as sub,
  starts_with(o_orderpriority, '1-') as starts, split_part(o_orderpriority, '-', 2) as part, length(o_orderpriority) as len,
  strftime(o_orderdate, '%Y-%m') as ym, {WEEK.format('o_orderdate')} as week, {MONTH.format('o_orderdate')} as month,
  cast(o_orderdate as date) + 6 as plus6, cast({day(AS_OF)} - cast(o_orderdate as date) as int) as days, least(cast(o_orderdate as date), {day(AS_OF)}) as earlier,
  round(o_totalprice, 1) as r1, cast(round_even(o_orderkey / 2, 0) as bigint) as even, cast(round_even(o_orderkey / 2, 0) as bigint) as even2,
  cast(floor((cast(o_orderdate as date) - date '1998-01-05') / 7) as int) as block, coalesce(nullif(o_custkey % 5, 0), -1) as guard,
  round(o_orderkey / nullif(o_custkey % 3, 0), 6) as ratio, o_custkey // 7 as whole, round(sqrt(o_totalprice), 6) as root, strftime(o_orderdate, '%Y-%m-%d') as iso,
  if(o_orderpriority = '1-URGENT', 'u', null) as mapped, array_to_string(range(1, o_custkey % 4 + 2), '+') as seq, try_cast(o_orderpriority as int) as junk from orders""",
)
