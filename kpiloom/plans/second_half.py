"""Second-half board: own payment methods, quoting agencies and frequent buyers, each against its targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import dates, fixed
from kpiloom.functions.numbers import money, pct, rounded
from kpiloom.functions.text import contains_any, strip_prefix
from kpiloom.operators import calendar
from kpiloom.operators.aggregate import entity_counts
from kpiloom.operators.cumulative import cumulate, first_seen
from kpiloom.operators.joins import on_spine, skew_join
from kpiloom.operators.tables import inline
from kpiloom.plans.first_half import quotes_between
from kpiloom.plans.settings import Settings
from kpiloom.sources.tables import Tables, sales_since


def _spark(df: DataFrame):
    return df.sparkSession


def kr11(t: Tables, s: Settings) -> DataFrame:
    """Confirmed value paid with own methods per month, and its share of the target."""
    sales = sales_since(t.sales, s.own_methods_from).where(
        F.col("channel").contains(s.channel_token) & (F.col("transaction_status") == fixed.CONFIRMED)
    ).select("partition_period", "origin_product_id", "transaction_code", money("gb").alias("gb"))
    products = t.products.select(F.col("transaction_id").alias("origin_product_id"), "payment_methods")
    own = contains_any("payment_methods", fixed.OWN_METHODS)
    actual = (
        skew_join(sales, products, "origin_product_id", "inner")
        .groupBy(F.col("partition_period").alias("mes"))
        .agg(
            rounded(F.sum(F.when(own, F.col("gb"))), 2).alias("gb_metodo_propio"),
            rounded(F.sum("gb"), 2).alias("gb_total_usd"),
        )
    )
    targets = inline(_spark(sales), s.own_method_targets, "mes string, target double")
    out = on_spine(targets, actual, "mes", zero=["gb_metodo_propio", "gb_total_usd"])
    return out.select(
        "mes", "gb_metodo_propio", "gb_total_usd", "target", pct("gb_metodo_propio", "target", 1).alias("pct_cumplimiento")
    )


def kr21(t: Tables, s: Settings) -> DataFrame:
    """Agencies that quote per month against the target."""
    quotes = quotes_between(t, s, s.quoting_from, s.quoting_to).withColumn("mes", dates.month_start("d"))
    actual = entity_counts(quotes, ["mes"], {"agencias_cotizadoras": ("agency", None)})
    targets = inline(_spark(quotes), s.quoting_targets, "mes date, semanas int, target int")
    out = on_spine(targets, actual, "mes", zero=["agencias_cotizadoras"])
    return out.select(
        "mes", "semanas", "agencias_cotizadoras", "target", pct("agencias_cotizadoras", "target", 1).alias("pct_cumplimiento")
    )


def kr21_sem(t: Tables, s: Settings) -> DataFrame:
    """Agencies that quote per week and month, in the week and accumulated in the month."""
    return quoting_so_far(first_seen(weekly_quotes(t, s), "mes", "semana_inicio", "agency"))


def weekly_quotes(t: Tables, s: Settings, since: date | None = None, until: date | None = None) -> DataFrame:
    """Quotes by month and week, of the reported days or of the days ``since``..``until`` among them."""
    first, last = max(since or s.quoting_from, s.quoting_from), min(until or s.quoting_to, s.quoting_to)
    return quotes_between(t, s, first, last).withColumns({"mes": dates.month_start("d"), "semana_inicio": dates.week_start("d")})


def quoting_so_far(seen: DataFrame) -> DataFrame:
    out = cumulate(seen, "mes", "semana_inicio", "agency")
    return out.select(
        "mes", "semana_inicio", F.col("in_step").alias("agencias_semana"), F.col("cumulative").alias("agencias_acum_mes")
    )


def order_states(t: Tables, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Started commercial weeks, and the orders of affiliated agencies as they stood on each photo date."""
    orders = t.transactions.where(
        (F.col("reservation_year_month") >= F.lit(s.orders_month_from)) & (F.col("reservation_date") >= F.lit(s.orders_from))
        & (F.col("parent_channel") == fixed.AFFILIATES) & (F.col("line_of_business") == fixed.B2B)
    ).select(
        strip_prefix("partner_data_id", fixed.PARTNER_PREFIX, 3).alias("agencia_id"),
        F.to_date("reservation_date").alias("rd"), F.to_date("confirmation_date").alias("cd"),
        F.to_date("cancelation_date").alias("xd"),
    )
    weeks = calendar.expand_calendar(calendar.commercial_calendar(_spark(orders), s.calendar), s.as_of)
    return weeks, calendar.asof_state(orders, weeks)


def kr22(t: Tables, s: Settings) -> DataFrame:
    """Agencies with confirmed purchases in three or more commercial weeks, at the last week of each month with data."""
    weeks, states = order_states(t, s)
    latest = calendar.last_step(
        calendar.frequent_buyers(states), "periodo", "semana", ["frecuentes_conf"]
    )
    state = weeks.select("periodo", "semana", "estado")
    latest = latest.join(F.broadcast(state), ["periodo", "semana"]).select(
        F.col("periodo").alias("mes_comercial"), "estado", F.col("frecuentes_conf").alias("agencias_frecuentes")
    )
    targets = inline(_spark(weeks), s.frequent_targets, "mes_comercial string, semanas int, target int")
    out = on_spine(targets, latest, "mes_comercial", zero=["agencias_frecuentes"])
    return out.select(
        "mes_comercial", "semanas", F.coalesce("estado", F.lit(fixed.PENDING_STATE)).alias("estado"),
        "agencias_frecuentes", "target", pct("agencias_frecuentes", "target", 1).alias("pct_cumplimiento"),
    )


def kr22_sem(t: Tables, s: Settings) -> DataFrame:
    """Per commercial week: agencies buying in it, and agencies with three or more weeks so far."""
    weeks, states = order_states(t, s)
    buyers = calendar.frequent_buyers(states).select(
        "periodo", "semana", "compradoras_semana", F.col("frecuentes_conf").alias("frecuentes_acum")
    )
    out = on_spine(weeks, buyers, ["periodo", "semana"], zero=["compradoras_semana", "frecuentes_acum"])
    return out.select(
        F.col("periodo").alias("mes_comercial"), "semana", dates.iso_text("s_desde").alias("semana_inicio"), "estado",
        "compradoras_semana", "frecuentes_acum",
    )
