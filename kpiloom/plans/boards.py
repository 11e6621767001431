"""Figures derived from metric results: initiative boards and scorecards. Inputs are aggregated results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import dates, fixed
from kpiloom.functions.numbers import half_even
from kpiloom.operators import calendar, rollout, scorecard
from kpiloom.operators.joins import on_spine
from kpiloom.operators.ranking import with_places
from kpiloom.operators.tables import inline


def link_daily(daily: DataFrame) -> DataFrame:
    """Daily figures summed over the countries, missing values as 0."""
    values = ["ref", "non", "link", "sd", "scope", "nl", "scope_nr"]
    return daily.groupBy("d").agg(*[F.sum(F.coalesce(F.col(v), F.lit(0))).alias(v) for v in values])


def link_countries(country: DataFrame, totals: DataFrame, launches: Mapping[str, date]) -> DataFrame:
    """A row per launched country, zeros where nothing was sold yet."""
    spine = rollout.launch_table(country.sparkSession, launches)
    link = country.select("c", "nl", "gl", "ag", "nc", "rep")
    out = on_spine(on_spine(spine, link, "c"), totals.select("c", "gt", "nt"), "c")
    return out.select(
        "c", dates.iso_text("ld").alias("ld"),
        *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in ("nl", "gl", "ag", "gt", "nt", "nc", "rep")],
    )


def _one_row(*parts: DataFrame) -> DataFrame:
    """Parts of one row each, side by side; a missing part or value is 0."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in stacked.columns])


def _of(key: str, columns: Mapping[str, str]) -> list[Column]:
    """Values of the row with this key, for an aggregate over all rows."""
    return [F.max(F.when(F.col("c") == key, F.col(source))).alias(name) for name, source in columns.items()]


def link_total(country: DataFrame, totals: DataFrame) -> DataFrame:
    """The total row of the board: link rows, non-refundable sale and cancellations of the whole scope."""
    own = {v: v for v in ("nl", "gl", "ag", "nc", "gc", "rep")}
    return _one_row(country.agg(*_of("ALL", own), *_of("TOT", {"hnc": "nc"})), totals.agg(*_of("ALL", {v: v for v in ("gt", "nt", "agt")})))


def link_counterfactual_blocks(daily: DataFrame, launches: Mapping[str, date], as_of: date) -> DataFrame:
    """Non-refundable, total and refundable hotel value per country and block."""
    gl, gt = F.coalesce(F.col("gl"), F.lit(0.0)), F.coalesce(F.col("gt"), F.lit(0.0))
    return rollout.series_blocks(daily, launches, as_of, {"nonref": gl, "total": gt, "ref": gt - gl})


def package_blocks(daily: DataFrame, launch: date, countries: Sequence[str], as_of: date) -> DataFrame:
    """Package value per block of the one launch day, for the treated country and its controls."""
    return rollout.series_blocks(daily, {c: launch for c in countries}, as_of, {"pkg": F.col("gb")})


def package_totals(daily: DataFrame, launch: date, countries: Sequence[str]) -> DataFrame:
    """Package figures since the launch per country, zeros where there were none. Daily counts are added up."""
    since = daily.where(F.col("d") >= launch.isoformat()).groupBy("c").agg(
        *[F.sum(F.coalesce(F.col(v), F.lit(0))).alias(v) for v in ("gb", "n", "gb_pd", "n_pd")]
    )
    spine = rollout.launch_table(daily.sparkSession, {c: launch for c in countries}).select("c")
    out = on_spine(spine, since, "c", zero=["gb", "n", "gb_pd", "n_pd"])
    return out.select("c", *[half_even(v).alias(v) for v in ("gb", "n", "gb_pd", "n_pd")])


def wallet_countries(daily: DataFrame, totals: DataFrame, launches: Mapping[str, date]) -> DataFrame:
    """Wallet figures of each country since its launch. Daily distinct bookings are added up."""
    values = ["nw", "gw", "nt", "gt"]
    since = rollout.since_launch(daily.withColumn("d", F.to_date("d")), launches).groupBy("c").agg(
        *[F.sum(F.coalesce(F.col(v), F.lit(0))).alias(v) for v in values]
    )
    spine = rollout.launch_table(daily.sparkSession, launches)
    out = on_spine(on_spine(spine, since, "c", zero=values), totals, "c", zero=["agw", "agt"])
    return out.select("c", dates.iso_text("ld").alias("ld"), *values, "agw", "agt")


def wallet_total(countries: DataFrame, totals: DataFrame) -> DataFrame:
    return _one_row(
        countries.agg(*[F.sum(v).alias(v) for v in ("nw", "gw", "nt", "gt")]),
        totals.agg(*_of("ALL", {"agw": "agw", "agt": "agt"})),
    )


def deferred_board(daily: DataFrame, packages: DataFrame, country: str) -> DataFrame:
    """Daily sale of the country beside its package sale."""
    own = packages.where(F.col("c") == country).select(
        "d", F.col("gb").alias("pkg_gb"), F.col("n").alias("pkg_n"), F.col("gb_pd").alias("pkg_gb_pd"), F.col("n_pd").alias("pkg_n_pd")
    )
    return on_spine(daily, own, "d", zero=["pkg_gb", "pkg_n", "pkg_gb_pd", "pkg_n_pd"])


def grid_daily(daily: DataFrame) -> DataFrame:
    return daily.withColumns({v: F.coalesce(F.col(v), F.lit(0)) for v in ("gb_f", "n_f", "gb_c", "n_c")})


def promise_totals(sales: DataFrame) -> DataFrame:
    """Confirmed value of all groups per country; rows without a country are left out."""
    rows = sales.where((F.col("g") == fixed.ALL_GROUPS) & (F.col("st") == "C"))
    totals = rows.groupBy("c").agg(F.sum(F.coalesce(F.col("gb"), F.lit(0.0))).alias("gb"))
    return totals.where(F.col("c").isNotNull() & (F.col("c") != ""))


def promise_countries(sales: DataFrame) -> DataFrame:
    """Countries by falling confirmed value."""
    return promise_totals(sales).orderBy(F.col("gb").desc(), "c")


PROMISE_PARTS = {
    # part: (metric, key columns, values)
    "a": ("pp_a", ("d", "c", "g", "st", "prom"), ("n", "gb")),
    "mix": ("pp_m", ("d", "c", "m"), ("n", "gb")),
    "canc": ("pp_x", ("d", "c", "g2", "r"), ("n",)),
    "ctl": ("pp_ctl", ("p", "c"), ("pre_n", "pre_gb", "post_n", "post_gb", "post_prom", "post_prom_c")),
    "ag": (
        "pp_ag", ("p", "c"),
        ("pre_h_a", "pre_h_c", "post_h_a", "post_h_c", "post_n_a", "post_n_c", "act_pre", "hist_prom"),
    ),
    "weeks": ("pp_agw", ("w",), ("ag_ac", "ag_c")),
}


def promise_board(r: Mapping[str, DataFrame], launch: date, as_of: date) -> DataFrame:
    """The whole promise board in one long result: part, key (texts joined by "|"), measure, value (missing: 0).

    Parts: the window (days since the launch, keyed by the first day before it), the rank of each country, and the parts
    of ``PROMISE_PARTS`` from their (stored) results.
    """
    n, pre_from = calendar.symmetric_window(launch, as_of)
    ranked = with_places(promise_totals(r["pp_a"]), [F.col("gb").desc(), F.col("c").asc()], "rank")
    out = inline(r["pp_a"].sparkSession, [("window", pre_from.isoformat(), "n", float(n))], "part string, key string, measure string, value double")
    out = out.unionByName(_measures("countries", ranked, ("c",), ("rank",)))
    for part, (metric, keys, values) in PROMISE_PARTS.items():
        out = out.unionByName(_measures(part, r[metric], keys, values))
    return out


def _measures(part: str, rows: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(v).alias("measure"), F.coalesce(F.col(v).cast("double"), F.lit(0.0)).alias("value")) for v in values]
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return rows.select(F.lit(part).alias("part"), key.alias("key"), F.inline(F.array(*pairs)))


def attach_boards(initiatives: DataFrame, boards: Mapping[str, str]) -> DataFrame:
    """Board key of each initiative, looked up by ``name|launch date``."""
    keys = F.concat_ws("|", F.col("name"), dates.iso_text("launch"))
    lookup = F.create_map(*[F.lit(x) for pair in boards.items() for x in pair])
    return initiatives.withColumn("board", lookup[keys])


# Scorecards -----------------------------------------------------------------------------------------------------------


FIRST_HALF_MONTHLY = ("kr21", "kr22", "kr31", "kr32", "kr33")
FIRST_HALF_WEEKLY = ("kr21_sem", "kr22_sem", "kr31_sem", "kr32_sem")
FIRST_HALF_RUNNING = ("kr21_sem_cum", "kr22_sem_cum", "kr31_sem_cum", "kr32_sem_cum", "kr33_sem_cum")
SECOND_HALF_MONTHLY = ("kr11", "kr21", "kr22")


def first_half_actuals(r: Mapping[str, DataFrame]) -> DataFrame:
    """Monthly actual of the five first-half metrics, from their (stored) results."""
    evaluated = F.concat_ws(
        "-", F.substring(F.col("mes_evaluacion").cast("string"), 1, 4), F.substring(F.col("mes_evaluacion").cast("string"), 5, 2)
    )
    return scorecard.actuals_long(
        {
            "kr21": (scorecard.timeout_share(r["kr21"]), F.col("mes_deadline"), F.col("pct_timeout")),
            "kr22": (r["kr22"], F.col("creation_yearmonth"), F.col("cant_agencias_unicas")),
            "kr31": (r["kr31"], F.col("periodo"), F.col("net_rev_real")),
            "kr32": (r["kr32"], F.col("mes"), F.col("pct_activacion_comercial")),
            "kr33": (r["kr33"], evaluated, F.col("pct_aumento")),
        }
    )


def second_half_actuals(r: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Monthly actuals and row targets of the second-half metrics; a pending month has no actual."""
    buyers = F.when(F.col("estado") != fixed.PENDING_STATE, F.col("agencias_frecuentes"))
    columns = {
        "kr11": (r["kr11"], F.col("mes"), F.col("gb_metodo_propio")),
        "kr21": (r["kr21"], F.col("mes"), F.col("agencias_cotizadoras")),
        "kr22": (r["kr22"], F.col("mes_comercial"), buyers),
    }
    targets = {key: (rows, month, F.col("target")) for key, (rows, month, _) in columns.items()}
    return (
        scorecard.actuals_long(columns),
        scorecard.actuals_long(targets).withColumnRenamed("actual", "target"),
    )


def weekly_series(r: Mapping[str, DataFrame]) -> DataFrame:
    """Weekly values of the first-half metrics in long form: id, semana_inicio, value."""
    return _long(
        {
            "kr21": (r["kr21_sem"], "pct_timeout_client"),
            "kr22": (r["kr22_sem"], "cant_agencias_unicas"),
            "kr31": (r["kr31_sem"], "net_revenue_real"),
            "kr32": (r["kr32_sem"], "pct_activacion_comercial"),
        }
    )


def cumulative_series(r: Mapping[str, DataFrame]) -> DataFrame:
    """Month-to-date values of the first-half metrics; the time-out share is that of the month of the week's Monday."""
    timeouts = r["kr21_sem_cum"].where(dates.month_start("semana_inicio") == F.col("mes_deadline"))
    return _long(
        {
            "kr21": (timeouts, "pct_timeout_acum"),
            "kr22": (r["kr22_sem_cum"], "cant_agencias_acum_mes"),
            "kr31": (r["kr31_sem_cum"], "net_revenue_acum_mes"),
            "kr32": (r["kr32_sem_cum"], "pct_activacion_acum"),
            "kr33": (r["kr33_sem_cum"], "pct_aumento_acum"),
        }
    )


def _long(parts: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    out = None
    for key, (rows, value) in parts.items():
        part = rows.select(F.lit(key).alias("id"), "semana_inicio", F.col(value).cast("double").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out
