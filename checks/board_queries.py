"""Queries over metric results: initiative boards and scorecards, each beside its comparison SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks import metric_sql as M
from checks import roles as R
from checks.metric_sql import day, launches, members, pct, values
from checks.pairs import Pairs
from kpiloom.functions import fixed
from kpiloom.functions.numbers import half_even
from kpiloom.operators import cumulative, funnel, rollout, scorecard
from kpiloom.operators.calendar import symmetric_window
from kpiloom.plans import boards, first_half, initiatives, registry, second_half, usability
from kpiloom.session import scratch_path
from kpiloom.sources import snapshots

pairs = Pairs()
add = pairs.add
I = R.IMPACT


def usage(t, s):
    return usability.filter_usage(t, s, R.USAGE_FROM, R.USAGE_TO)


def impact(function):
    return lambda spark, sf_dir: function(R.roles(spark, sf_dir), I)


def from_stored(metrics, keys, settings, function):
    """A query over metric results that are computed once and stored."""
    def run(spark, sf_dir):
        path = scratch_path(spark, "board")
        return function(registry.stored(metrics, keys, R.roles(spark, sf_dir), settings, path), settings)

    return run


def board(keys, function):
    return from_stored(registry.INITIATIVES, keys, I, function)


# Link board -----------------------------------------------------------------------------------------------------------

LINK_VALUES = ("ref", "non", "link", "sd", "scope", "nl", "scope_nr")


def num(c: str, kind: str = "double") -> str:
    return f"cast({c} as {kind})"


add(
    "link_daily", impact(lambda t, s: boards.link_daily(initiatives.ldp_daily(t, s))),
    "select d, " + ", ".join(
        num(f"sum(coalesce({v}, 0))", "bigint" if v == "nl" else "double") + f" as {v}" for v in LINK_VALUES
    ) + f" from ({M.LDP_DAILY}) group by d",
)
LAUNCH = f"(select * from {values([(c, d) for c, d in I.link_launches.items()])} l(c, ld))"
add(
    "link_countries",
    board(("ldp_country", "ldp_totals"), lambda r, s: boards.link_countries(r["ldp_country"], r["ldp_totals"], s.link_launches)),
    f"""select l.c, cast(l.ld as varchar) as ld, coalesce(x.nl, 0) as nl, coalesce(x.gl, 0) as gl, coalesce(x.ag, 0) as ag,
  coalesce(y.gt, 0) as gt, coalesce(y.nt, 0) as nt, coalesce(x.nc, 0) as nc, coalesce(x.rep, 0) as rep
from {LAUNCH} l left join ({M.LDP_COUNTRY}) x on x.c = l.c left join ({M.LDP_TOTALS}) y on y.c = l.c""",
)
add(
    "link_total", board(("ldp_country", "ldp_totals"), lambda r, s: boards.link_total(r["ldp_country"], r["ldp_totals"])),
    f"""select x.nl, coalesce(x.gl, 0) as gl, x.ag, x.nc, coalesce(x.gc, 0) as gc, x.rep, coalesce(y.gt, 0) as gt, y.nt, y.agt, z.nc as hnc
from ({M.LDP_COUNTRY}) x, ({M.LDP_TOTALS}) y, ({M.LDP_COUNTRY}) z where x.c = 'ALL' and y.c = 'ALL' and z.c = 'TOT'""",
)


def blocked(daily: str, table: dict) -> str:
    """Daily rows with their block, complete blocks only."""
    return f"""select * from (select *, cast(floor((cast(d as date) - ld) / 7) as int) as b from (
  select *, {launches(table, 'c')} as ld from ({daily}))) where ld + 7 * (b + 1) <= {day(I.as_of)}"""


add(
    "payment_mix_blocks", impact(lambda t, s: rollout.mix_blocks(initiatives.ldp_mix(t, s), s.link_launches, s.as_of)),
    f"""select c, b, g, cast(sum(n) as bigint) as n_sum, cast(round_even(round(sum(coalesce(gb, 0)), 6), 0) as bigint) as gb
from ({blocked(M.LDP_MIX, I.link_launches)}) where b >= -4 group by all""",
)


def fit_sql(series: str, windows) -> str:
    """Grid, line and band of the blocks in ``series`` (series, c, b, value)."""
    quantiles = " ".join(f"when {k} then {v}" for k, v in fixed.T_QUANTILES.items())
    return f"""with s as ({series}),
reach as (select c, max(b) as bmax from s group by c having max(b) >= 0),
spine as (select distinct series, c, bmax, w from s join reach using (c), (select unnest({list(windows)}) as w)),
grid as (
  select spine.series, spine.c, w, spine.x as b, coalesce(value, 0e0) as value
  from (select *, cast(unnest(range(-w, bmax + 1)) as int) as x from spine) spine
    left join s on s.series = spine.series and s.c = spine.c and s.b = spine.x),
line as (
  select series, c, w, regr_intercept(value, b) as a0, regr_slope(value, b) as a1, regr_avgx(value, b) as mx, regr_sxx(value, b) as sxx,
    sqrt(greatest(regr_syy(value, b) - regr_slope(value, b) * regr_sxy(value, b), 0) / (count(*) - 2)) as sd, count(*) as n
  from grid where b < 0 group by all),
fitted as (
  select *, a0 + a1 * b as fit,
    if(b >= 0, (case n - 2 {quantiles} else {fixed.T_DEFAULT} end) * sd * sqrt(1 + 1e0 / n + (b - mx) ** 2 / sxx), 0e0) as half
  from grid join line using (series, c, w))"""


def whole(c: str) -> str:
    return f"cast(round_even(round({c}, 6), 0) as bigint)"


ROWS = (
    f"select series, c, b, {whole('value')} as actual, {whole('fit')} as fit, {whole('greatest(0, fit - half)')} as low, "
    f"{whole('fit + half')} as high from fitted"
)
INCREMENT = f"select series, c, w, {whole('sum(value - fit)')} as increment from fitted where b >= 0 group by all"
LINK_SERIES = f"""select series, c, b, cast(sum(value) as double) as value from (
  select 'nonref' as series, c, b, coalesce(gl, 0) as value from ({blocked(M.CF_DAILY, I.link_launches)})
  union all select 'total', c, b, coalesce(gt, 0) from ({blocked(M.CF_DAILY, I.link_launches)})
  union all select 'ref', c, b, coalesce(gt, 0) - coalesce(gl, 0) from ({blocked(M.CF_DAILY, I.link_launches)})) group by all"""
PKG_LAUNCH = {c: I.deferred_launch for c in I.package_countries}
PKG_SERIES = f"select 'pkg' as series, c, b, cast(sum(coalesce(gb, 0)) as double) as value from ({blocked(M.PKG_DAILY, PKG_LAUNCH)}) group by all"


def link_blocks(t, s):
    return boards.link_counterfactual_blocks(initiatives.cf_daily(t, s), s.link_launches, s.as_of)


def pkg_blocks(t, s):
    return boards.package_blocks(initiatives.pkg_daily(t, s), s.deferred_launch, s.package_countries, s.as_of)


add("series_blocks", impact(lambda t, s: link_blocks(t, s).withColumn("value", half_even("value"))),
    f"select series, c, b, {whole('value')} as value from ({LINK_SERIES})")
add("counterfactual", impact(lambda t, s: rollout.counterfactual(link_blocks(t, s))),
    f"{fit_sql(LINK_SERIES, [fixed.MAIN_WINDOW])} {ROWS}")
add("counterfactual_increments", impact(lambda t, s: rollout.increments(link_blocks(t, s))),
    f"{fit_sql(LINK_SERIES, fixed.FIT_WINDOWS)} {INCREMENT}")
add("package_counterfactual", impact(lambda t, s: rollout.counterfactual(pkg_blocks(t, s))),
    f"{fit_sql(PKG_SERIES, [fixed.MAIN_WINDOW])} {ROWS}")
add("package_increments", impact(lambda t, s: rollout.increments(pkg_blocks(t, s))),
    f"{fit_sql(PKG_SERIES, fixed.FIT_WINDOWS)} {INCREMENT}")
add(
    "package_totals",
    impact(lambda t, s: boards.package_totals(initiatives.pkg_daily(t, s), s.deferred_launch, s.package_countries)),
    f"""select l.c, {whole('sum(coalesce(gb, 0))')} as gb, cast(sum(coalesce(n, 0)) as bigint) as n, {whole('sum(coalesce(gb_pd, 0))')} as gb_pd,
  cast(sum(coalesce(n_pd, 0)) as bigint) as n_pd
from (select unnest({list(I.package_countries)}) as c) l left join (select * from ({M.PKG_DAILY}) where d >= '{I.deferred_launch}') x on x.c = l.c
group by l.c""",
)

# Wallet, deferred, grid and promise boards ----------------------------------------------------------------------------

WALLET_SQL = f"""select l.c, cast(l.ld as varchar) as ld, cast(coalesce(sum(nw), 0) as bigint) as nw, cast(coalesce(sum(gw), 0) as double) as gw,
  cast(coalesce(sum(nt), 0) as bigint) as nt, cast(coalesce(sum(gt), 0) as double) as gt, coalesce(any_value(y.agw), 0) as agw,
  coalesce(any_value(y.agt), 0) as agt
from (select * from {values(list(I.wallet_launches.items()))} v(c, ld)) l
  left join ({M.WALLET_DAILY}) x on x.c = l.c and cast(x.d as date) >= l.ld left join ({M.WALLET_AGENCIES}) y on y.c = l.c group by l.c, l.ld"""


WALLET = ("wallet_daily", "wallet_agencies")


def wallet_board(r, s):
    return boards.wallet_countries(r["wallet_daily"], r["wallet_agencies"], s.wallet_launches)


add("wallet_countries", board(WALLET, wallet_board), WALLET_SQL)
add(
    "wallet_total", board(WALLET, lambda r, s: boards.wallet_total(wallet_board(r, s), r["wallet_agencies"])),
    f"""select cast(sum(nw) as bigint) as nw, sum(gw) as gw, cast(sum(nt) as bigint) as nt, sum(gt) as gt,
  (select agw from ({M.WALLET_AGENCIES}) where c = 'ALL') as agw, (select agt from ({M.WALLET_AGENCIES}) where c = 'ALL') as agt from ({WALLET_SQL})""",
)
add(
    "deferred_board",
    board(("pd_daily", "pkg_daily"), lambda r, s: boards.deferred_board(r["pd_daily"], r["pkg_daily"], s.deferred_country)),
    f"""select x.d, x.n, x.gb, coalesce(y.gb, 0) as pkg_gb, coalesce(y.n, 0) as pkg_n, coalesce(y.gb_pd, 0) as pkg_gb_pd, coalesce(y.n_pd, 0) as pkg_n_pd
from ({M.PD_DAILY}) x left join (select * from ({M.PKG_DAILY}) where c = '{I.deferred_country}') y on y.d = x.d""",
)
add("grid_daily", impact(lambda t, s: boards.grid_daily(initiatives.gv_daily(t, s))),
    f"select d, c, coalesce(gb_f, 0) as gb_f, n_f, coalesce(gb_c, 0) as gb_c, n_c from ({M.GV_DAILY})")
add("promise_countries", impact(lambda t, s: boards.promise_countries(initiatives.pp_a(t, s))),
    f"select c, sum(coalesce(gb, 0)) as gb from ({M.PP_A}) where g = 'TT' and st = 'C' and c <> '' group by c")
PRE_DAYS, PRE_FROM = symmetric_window(I.promise_launch, I.as_of)
add(
    "promise_board",
    board([m for m, _, _ in boards.PROMISE_PARTS.values()], lambda r, s: boards.promise_board(r, s.promise_launch, s.as_of)),
    f"""select 'window' as part, '{PRE_FROM}' as key, 'n' as measure, {float(PRE_DAYS)}e0 as value
union all select 'countries', c, 'rank', cast(row_number() over (order by gb desc, c) as double)
  from (select c, sum(coalesce(gb, 0)) as gb from ({M.PP_A}) where g = 'TT' and st = 'C' and c <> '' group by c)"""
    + "".join(
        f" union all select '{part}', concat_ws('|', {', '.join(f'cast({k} as varchar)' for k in keys)}), '{v}', coalesce(cast({v} as double), 0e0) "
        f"from ({M.INITIATIVES[metric]})"
        for part, (metric, keys, measures) in boards.PROMISE_PARTS.items() for v in measures
    ),
)
BOARD_MAP = {"NATION_3|1995-01-01": "ldp", "NATION_7|1995-01-02": "wallet", "NATION_12|1995-01-01": "gv"}


def _nation_starts(spark, sf_dir):
    read = R._reader(spark, sf_dir)
    nation = read("nation").select("n_nationkey", F.col("n_name").alias("name"))
    orders = R._order_customer(read).groupBy("c_nationkey").agg(F.min(F.to_date("o_orderdate")).alias("launch"))
    return boards.attach_boards(orders.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("name", "launch"), BOARD_MAP)


add(
    "attach_boards", _nation_starts,
    "select name, launch, case name || '|' || cast(launch as varchar) "
    + " ".join(f"when '{k}' then '{v}'" for k, v in BOARD_MAP.items())
    + " end as board from (select n_name as name, cast(min(o_orderdate) as date) as launch "
    "from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name)",
)
add(
    "week_window", lambda spark, sf_dir: snapshots.week_window(usage(R.roles(spark, sf_dir), R.CLICKS)),
    f"""select count(distinct week_start) as weeks, min(week_start) as first_day, max(week_start) + 6 as last_day
from ({M.CLICKS['filter_usage']})""",
)



ORDERED_SQL = f"""select 'filter_usage_text' as report, product || ' ' || week_start || ' ' || country as label,
  row_number() over (order by visits desc, product, week_start, country) as position from ({M.CLICKS['filter_usage_text']})
union all select 'h2.kr21_sem', mes || ' ' || semana_inicio, row_number() over (order by semana_inicio, mes) from ({M.SECOND['kr21_sem']})
union all select 'h1.kr21', mes_deadline || ' ' || status, row_number() over (order by mes_deadline, status) from ({M.FIRST['kr21']})"""


def report_order(spark, sf_dir):
    """Rows of three reports with their place in them."""
    t = R.roles(spark, sf_dir)
    reports = {
        "filter_usage_text": (funnel.packed_usage(usage(t, R.CLICKS)), ("product", "week_start", "country")),
        "h2.kr21_sem": (second_half.kr21_sem(t, R.SECOND), ("mes", "semana_inicio")),
        "h1.kr21": (first_half.kr21(t, R.FIRST), ("mes_deadline", "status")),
    }
    out = None
    for key, (rows, label) in reports.items():
        text = F.when(F.col(label[-1]).isNotNull(), F.concat_ws(" ", *[F.col(c).cast("string") for c in label]))
        part = registry.numbered(key, rows).select(F.lit(key).alias("report"), text.alias("label"), "position")
        out = part if out is None else out.unionByName(part)
    return out


add("report_order", report_order, ORDERED_SQL)


# Scorecards -----------------------------------------------------------------------------------------------------------

AS_OF = date(1999, 11, 17)
MONTHS = tuple(f"1999-{m:02d}" for m in range(7, 13))
BOARD = (
    ("kr21", "es", 7, True, (22, 20, 18.25, 16.85, 15.75, 15)),
    ("kr22", "es", 13, False, (180, 190, 195, 200, 205, 210)),
    ("kr31", "ce", 16, False, (30_000_000, 31_000_000, 32_000_000, 33_000_000, 34_000_000, 35_000_000)),
    ("kr32", "ce", 7, False, (30, 35, 40, 45, 50, 55)),
    ("kr33", "ce", 7, False, (2, 2.5, 3, 3.5, 4, 5)),
)
ACTUALS_SQL = f"""select 'kr21' as id, strftime(mes_deadline, '%Y-%m') as month,
    cast(sum(if(status = 'Time_out_client', reservas, 0)) as bigint) * 100e0 / sum(reservas) as actual from ({M.FIRST['kr21']}) group by all
  union all select 'kr22', creation_yearmonth, cant_agencias_unicas from ({M.FIRST['kr22']})
  union all select 'kr31', periodo, net_rev_real from ({M.FIRST['kr31']})
  union all select 'kr32', strftime(mes, '%Y-%m'), pct_activacion_comercial from ({M.FIRST['kr32']})
  union all select 'kr33', cast(mes_evaluacion as varchar)[:4] || '-' || cast(mes_evaluacion as varchar)[5:], pct_aumento from ({M.FIRST['kr33']})"""


def board_sql(board, months) -> str:
    rows = [
        (b[0], i, b[1], float(b[2]), b[3], m, "q1" if k < 3 else "q2", float(b[4][k]))
        for i, b in enumerate(board) for k, m in enumerate(months)
    ]
    text = ", ".join(
        f"('{r[0]}', {r[1]}, '{r[2]}', {r[3]}e0, {str(r[4]).lower()}, '{r[5]}', '{r[6]}', {r[7]}e0)" for r in rows
    )
    return f"select * from (values {text}) b(id, ord, squad, weight, inverted, month, quarter, target)"


ATTAIN = (
    "case when actual is null or coalesce(target, 0) = 0 then null when inverted and actual = 0 then 130e0 "
    "when inverted then target / actual * 100 else actual / target * 100 end"
)
CAPPED = "case when pct < 70 then 0e0 when pct > 130 then 130e0 else pct end"


def chip(p: str) -> str:
    return f"case when {p} is null then 'na' when {p} >= 100 then 'ok' when {p} >= 80 then 'warn' else 'bad' end"


def scores_sql(actuals: str, board: str, operator: str, own: str | None = None) -> str:
    current = f"{AS_OF:%Y-%m}"
    target = "coalesce(own.own, b.target)" if own else "b.target"
    join = f"left join ({own}) own on own.id = b.id and own.month = b.month" if own else ""
    return f"""with board as ({board}), actuals as ({actuals}),
rated as (
  select b.id, b.month, quarter, {target} as target, ord, squad, weight, inverted, if(b.month <= '{current}', actual, null) as actual
  from board b left join actuals a on a.id = b.id and a.month = b.month {join}),
scored as (select *, if(month {operator} '{current}', {ATTAIN}, null) as pct from rated),
final as (
  select *, {CAPPED} as effective, if(month {operator} '{current}', {chip('pct')}, null) as band0 from scored)"""


FINAL = """select id, month, quarter, target, ord, squad, weight, inverted, actual, pct, effective,
  if(band0 is null, null, case when effective is null then 'na' when effective >= 100 then 'ok' when effective >= 80 then 'warn' else 'bad' end) as band,
  case when pct < 70 then 'floored' when pct > 130 then 'capped' end as note, {partial} as partial from final"""
SCORES = scores_sql(ACTUALS_SQL, board_sql(BOARD, MONTHS), "<")


def first(function):
    """Over the stored monthly results and the actuals from them."""
    def run(r, _):
        actuals = boards.first_half_actuals(r)
        return function(actuals.sparkSession, r, actuals)

    return from_stored(registry.FIRST_HALF, boards.FIRST_HALF_MONTHLY, R.FIRST, run)


def tables(spark):
    return scorecard.board_table(spark, BOARD), scorecard.target_table(spark, MONTHS, BOARD)


def weighted(scores):
    return scorecard.weighted_total(scores).withColumn("pct", F.round("pct", 6))


def month_scores(spark, actuals):
    board, targets = tables(spark)
    return scorecard.month_scores(board, targets, actuals, AS_OF)


add("scorecard_actuals", first(lambda spark, t, a: a), ACTUALS_SQL)
add("scorecard_month", first(lambda spark, t, a: month_scores(spark, a)), f"{SCORES} {FINAL.format(partial='false')}")
add(
    "scorecard_spans", first(lambda spark, t, a: scorecard.span_means(month_scores(spark, a), ["id"], "pct").withColumn("pct", F.round("pct", 6))),
    f"{SCORES}, x as (select id, unnest([quarter, 'half']) as span, pct from final) select id, span, round(avg(pct), 6) as pct from x group by all",
)
WEIGHTED = """, m as (
  select month, quarter, sum(effective * weight) / nullif(sum(weight) filter (where effective is not null), 0) as pct from final group by all)
select month as period, round(pct, 6) as pct from m union all select span, round(avg(pct), 6) from (select unnest([quarter, 'half']) as span, pct from m) group by span"""
add("scorecard_weighted", first(lambda spark, t, a: weighted(month_scores(spark, a))), SCORES + WEIGHTED)
add(
    "scorecard_squad",
    first(
        lambda spark, t, a: weighted(
            scorecard.month_scores(scorecard.squad_filter(tables(spark)[0], "es"), tables(spark)[1], a, AS_OF)
        )
    ),
    scores_sql(ACTUALS_SQL, f"select * from ({board_sql(BOARD, MONTHS)}) where squad = 'es'", "<") + WEIGHTED,
)
OWN = f"select 'kr31' as id, periodo as month, net_rev_target as own from ({M.FIRST['kr31']})"
add(
    "scorecard_row_targets",
    first(
        lambda spark, t, a: scorecard.month_scores(
            tables(spark)[0],
            scorecard.row_targets(
                tables(spark)[1],
                t["kr31"].select(F.lit("kr31").alias("id"), F.col("periodo").alias("month"), F.col("net_rev_target").alias("target")),
            ),
            a, AS_OF,
        )
    ),
    scores_sql(ACTUALS_SQL, board_sql(BOARD, MONTHS), "<", OWN) + " " + FINAL.format(partial="false"),
)
add(
    "scorecard_progress", first(lambda spark, t, a: scorecard.progress(*tables(spark), a, AS_OF)),
    f"""with board as ({board_sql(BOARD, MONTHS)}), x as (
  select b.*, actual from board b left join ({ACTUALS_SQL}) a on a.id = b.id and a.month = b.month
  where b.month = (select max(month) from board where month <= '{AS_OF:%Y-%m}')),
y as (select *, {ATTAIN} as pct, if(inverted, target - actual, actual - target) as delta from x), z as (select *, {CAPPED} as e from y)
select id, month, actual, target, pct, delta, delta >= 0 as good, {chip('e')} as band, if(pct is null, 0e0, least(pct, 100e0)) as bar from z""",
)

# The second-half board: current month scored as partial, targets from the rows.
H2_AS_OF = R.SECOND.as_of
H2_MONTHS = tuple(f"1998-{m:02d}" for m in range(1, 7))
H2_BOARD = (
    ("kr11", "es", 1, False, tuple(1_000_000.0 * m for m in range(1, 7))),
    ("kr12", "es", 0, True, (3.64, 3.6, 3.98, 3.72, 3.93, 3.49)),
    ("kr21", "ce", 1, False, (40, 45, 50, 55, 60, 65)),
    ("kr22", "ce", 1, False, (10, 11, 12, 13, 14, 15)),
)
H2_ACTUALS = f"""select 'kr11' as id, mes as month, gb_metodo_propio as actual, target as own from ({M.SECOND['kr11']})
  union all select 'kr21', strftime(mes, '%Y-%m'), agencias_cotizadoras, target from ({M.SECOND['kr21']})
  union all select 'kr22', mes_comercial, if(estado <> 'PENDIENTE', agencias_frecuentes, null), target from ({M.SECOND['kr22']})"""


def second_scores(r, _):
    actuals, own = boards.second_half_actuals(r)
    spark = actuals.sparkSession
    targets = scorecard.row_targets(scorecard.target_table(spark, H2_MONTHS, H2_BOARD), own)
    return scorecard.month_scores(scorecard.board_table(spark, H2_BOARD), targets, actuals, H2_AS_OF, closed_only=False)


h2_scores = from_stored(registry.SECOND_HALF, boards.SECOND_HALF_MONTHLY, R.SECOND, second_scores)
H2_SQL = scores_sql(
    f"select id, month, cast(actual as double) as actual from ({H2_ACTUALS})", board_sql(H2_BOARD, H2_MONTHS), "<=",
    f"select id, month, cast(own as double) as own from ({H2_ACTUALS})",
).replace(f"{AS_OF:%Y-%m}", f"{H2_AS_OF:%Y-%m}")
add("scorecard_partial_month", h2_scores,
    H2_SQL + " " + FINAL.format(partial=f"month = '{H2_AS_OF:%Y-%m}' and pct is not null"))
add("scorecard_partial_weighted", lambda spark, sf_dir: weighted(h2_scores(spark, sf_dir)), H2_SQL + WEIGHTED)

# Weekly and monitor views.
CUMULATIVE_SQL = f"""select 'kr21' as id, semana_inicio, pct_timeout_acum as value from ({M.FIRST['kr21_sem_cum']})
    where date_trunc('month', semana_inicio) = mes_deadline
  union all select 'kr22', semana_inicio, cast(cant_agencias_acum_mes as double) from ({M.FIRST['kr22_sem_cum']})
  union all select 'kr31', semana_inicio, net_revenue_acum_mes from ({M.FIRST['kr31_sem_cum']})
  union all select 'kr32', semana_inicio, pct_activacion_acum from ({M.FIRST['kr32_sem_cum']})
  union all select 'kr33', semana_inicio, pct_aumento_acum from ({M.FIRST['kr33_sem_cum']})"""
WEEKLY_SQL = f"""select 'kr21' as id, semana_inicio, pct_timeout_client as value from ({M.FIRST['kr21_sem']})
  union all select 'kr22', semana_inicio, cast(cant_agencias_unicas as double) from ({M.FIRST['kr22_sem']})
  union all select 'kr31', semana_inicio, net_revenue_real from ({M.FIRST['kr31_sem']})
  union all select 'kr32', semana_inicio, pct_activacion_comercial from ({M.FIRST['kr32_sem']})"""


weekly = from_stored(registry.FIRST_HALF, boards.FIRST_HALF_WEEKLY, R.FIRST, lambda r, _: boards.weekly_series(r))
running = from_stored(registry.FIRST_HALF, boards.FIRST_HALF_RUNNING, R.FIRST, lambda r, _: boards.cumulative_series(r))


add(
    "scorecard_weekly",
    lambda spark, sf_dir: scorecard.weekly_attainment(running(spark, sf_dir), tables(spark)[1], tables(spark)[0], AS_OF, MONTHS[0]).drop("month"),
    f"""with board as ({board_sql(BOARD, MONTHS)}), x as (
  select w.id, semana_inicio, value as actual, b.target, d.inverted from ({CUMULATIVE_SQL}) w
    left join board b on b.id = w.id and b.month = strftime(semana_inicio, '%Y-%m')
    join (select distinct id, inverted from board) d on d.id = w.id
  where strftime(semana_inicio, '%Y-%m') >= '{MONTHS[0]}' and semana_inicio < date_trunc('week', {day(AS_OF)})),
y as (select *, {ATTAIN} as pct from x)
select id, semana_inicio, actual as value, target, pct, {chip('pct')} as band from y""",
)


def week_detail(spark, sf_dir):
    rows = first_half.kr21_sem_cum(R.roles(spark, sf_dir), R.FIRST)
    steps = cumulative.step_values(rows, "mes_deadline", "semana_inicio", ["total_reservas_acum", "timeouts_acum"])
    rate = F.col("timeouts_acum") * 100.0 / F.nullif(F.col("total_reservas_acum"), F.lit(0))
    return steps.select("semana_inicio", "mes_deadline", F.col("total_reservas_acum").alias("total"), F.col("timeouts_acum").alias("timeouts"), rate.cast("double").alias("pct"))


add(
    "week_detail", week_detail,
    f"""select semana_inicio, mes_deadline, total, timeouts, timeouts * 100e0 / nullif(total, 0) as pct from (
  select semana_inicio, mes_deadline, total_reservas_acum - lag(total_reservas_acum, 1, 0) over w as total, timeouts_acum - lag(timeouts_acum, 1, 0) over w as timeouts
  from ({M.FIRST['kr21_sem_cum']}) window w as (partition by mes_deadline order by semana_inicio))""",
)
TARGET_SQL = f"select id, month, target from ({board_sql(BOARD, MONTHS)})"


def cards(spark, sf_dir):
    out = scorecard.monitor_cards(scorecard.month_filter(weekly(spark, sf_dir), None), tables(spark)[1])
    return out.select(
        "id", "best", "best_week", "worst", "worst_week", "last", "last_week", "month", "weeks_in_month", "target", "gap",
        F.round("mean", 4).alias("mean"), F.round("mean_complete", 4).alias("mean_complete"), F.round("mean_gap", 4).alias("mean_gap"),
    )


add(
    "monitor_cards", cards,
    f"""with r as (select * from ({WEEKLY_SQL}) where value is not null),
c as (
  select id, max(value) as best, min(value) as worst, arg_max(value, semana_inicio) as last, max(semana_inicio) as last_week, avg(value) as mean from r group by id)
select c.id, best, (select min(semana_inicio) from r where r.id = c.id and value = best) as best_week, worst,
  (select min(semana_inicio) from r where r.id = c.id and value = worst) as worst_week, last, last_week, strftime(last_week, '%Y-%m') as month,
  (select count(distinct semana_inicio) from r where r.id = c.id and strftime(semana_inicio, '%Y-%m') = strftime(last_week, '%Y-%m')) as weeks_in_month,
  target, last - target as gap, round(mean, 4) as mean,
  round(coalesce((select avg(value) from r where r.id = c.id and semana_inicio < last_week), 0), 4) as mean_complete, round(mean - 70, 4) as mean_gap
from c left join ({TARGET_SQL}) t on t.id = c.id and t.month = strftime(last_week, '%Y-%m')""",
)
add(
    "monitor_month", lambda spark, sf_dir: scorecard.month_filter(weekly(spark, sf_dir), "1999-10"),
    f"select * from ({WEEKLY_SQL}) where strftime(semana_inicio, '%Y-%m') = '1999-10'",
)
add(
    "frequency_cards",
    lambda spark, sf_dir: scorecard.frequency_cards(first_half.kr33(R.roles(spark, sf_dir), R.FIRST), R.MAX_DAY, 3.0),
    f"""with r as (select * from ({M.FIRST['kr33']}))
select max(pct_aumento) as best, min(mes_evaluacion) filter (where pct_aumento = (select max(pct_aumento) from r)) as best_month,
  arg_max(pct_aumento, mes_evaluacion) as last, max(mes_evaluacion) as last_month, arg_max(pct_aumento, mes_evaluacion) >= 3 as last_good,
  if(bool_or(mes_evaluacion = 200006), arg_max(pct_aumento, mes_evaluacion), 0e0) as current from r""",
)


def trends(spark, sf_dir):
    rows = weekly(spark, sf_dir)
    return cumulative.worsening(rows, "id", "semana_inicio", "value", F.col("id") == "kr21")


add(
    "trend_flag", trends,
    f"""with r as (
  select id, id = 'kr21' as inv, value as last, lag(value) over w as prev, lag(value, 2) over w as prev2,
    row_number() over (partition by id order by semana_inicio desc) as k
  from ({WEEKLY_SQL}) where value is not null window w as (partition by id order by semana_inicio))
select id, inv, last, prev, if(inv, last < prev, last > prev) as up,
  coalesce(if(inv, last > prev and prev > prev2, last < prev and prev < prev2), false) as declining from r where k = 1 and prev is not null""",
)
add(
    "chart_series",
    from_stored(
        registry.FIRST_HALF, (*boards.FIRST_HALF_WEEKLY, *boards.FIRST_HALF_RUNNING), R.FIRST,
        lambda r, _: scorecard.chart_series(boards.weekly_series(r), boards.cumulative_series(r), tables(r["kr21_sem"].sparkSession)[1]),
    ),
    f"""select w.id, w.semana_inicio, w.value, strftime(w.semana_inicio, '%Y-%m') as month, c.value as cumulative, target
from ({WEEKLY_SQL}) w left join ({CUMULATIVE_SQL}) c on c.id = w.id and c.semana_inicio = w.semana_inicio
  left join ({TARGET_SQL}) t on t.id = w.id and t.month = strftime(w.semana_inicio, '%Y-%m')""",
)
