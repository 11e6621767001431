"""Agency cohorts: activation of quoting agencies and uplift of the booking frequency.

Two series of the same entities are brought together by one grouping of their union instead of a join of two
aggregates: each side is reduced map-side and only (period, entity) pairs are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import dates
from kpiloom.functions.numbers import pct
from kpiloom.operators.cumulative import cumulate, first_steps


def paired(left: DataFrame, right: DataFrame, by: list[str], left_n: str, right_n: str) -> DataFrame:
    """Rows of both sides counted per key."""
    both = left.select(*by, F.lit(1).alias(left_n), F.lit(0).alias(right_n)).unionByName(
        right.select(*by, F.lit(0).alias(left_n), F.lit(1).alias(right_n))
    )
    return both.groupBy(*by).agg(F.sum(left_n).alias(left_n), F.sum(right_n).alias(right_n))


def activation(quotes: DataFrame, sales: DataFrame, period: str, entity: str) -> DataFrame:
    """Of the entities that quoted in a period, those that also sold in it; and the number of quotes."""
    return activation_shares(paired(quotes, sales, [period, entity], "_q", "_s"), period, entity)


def activation_shares(pairs: DataFrame, period: str, entity: str) -> DataFrame:
    """``activation`` from the number of quotes (_q) and sales (_s) per period and entity."""
    counted = pairs.where(F.col("_q") > 0).groupBy(period).agg(
        F.count(entity).alias("quoting"),
        F.count(F.when(F.col("_s") > 0, F.col(entity))).alias("converted"),
        F.sum("_q").alias("quotes"),
    )
    return counted.withColumn("pct", pct("converted", "quoting"))


def activation_rows(quotes: DataFrame, sales: DataFrame, period: str, step: str, entity: str) -> DataFrame:
    """Both series in one: the step of a quote in ``_q``, of a sale in ``_s``."""
    return quotes.select(period, entity, F.col(step).alias("_q"), F.lit(None).cast("date").alias("_s")).unionByName(
        sales.select(period, entity, F.lit(None).cast("date").alias("_q"), F.col(step).alias("_s"))
    )


def activation_counts(seen: DataFrame, period: str, step: str, entity: str, by: str = "step") -> DataFrame:
    """Running counts from the first steps of ``activation_rows`` with the least ``_s`` as ``sold``."""
    both_done = F.when(F.col("sold").isNotNull(), F.greatest("first", "sold"))
    quoting = seen.where(F.col("first").isNotNull()).withColumn("first_sold", both_done).drop("sold")
    out = cumulate(quoting, period, step, entity, ["sold"], by)
    return out.withColumn("pct", pct("cumulative_sold", "cumulative"))


def activation_cumulative(quotes: DataFrame, sales: DataFrame, period: str, step: str, entity: str, by: str = "step") -> DataFrame:
    """Entities that quoted up to each step of the period, and of those the ones that sold up to it."""
    both = activation_rows(quotes, sales, period, step, entity)
    return activation_counts(first_steps(both, period, "_q", entity, {"sold": F.col("_s")}), period, step, entity, by)


def booking_pairs(bookings: DataFrame, partner: str = "partner_id") -> DataFrame:
    """Bookings of each partner in a month beside those of the month before it.

    ``bookings``: mes (yyyymm), partner, reservas. Each row is sent to its own month and to the next one, which replaces
    the self join; a month without bookings is NULL.
    """
    current = F.struct(F.col("mes").alias("mes_evaluacion"), F.lit(None).cast("long").alias("prev_n"), F.col("reservas").alias("cur_n"))
    previous = F.struct(
        dates.next_yyyymm("mes").alias("mes_evaluacion"), F.col("reservas").alias("prev_n"), F.lit(None).cast("long").alias("cur_n")
    )
    return (
        bookings.select(partner, F.inline(F.array(current, previous)))
        .groupBy("mes_evaluacion", partner)
        .agg(F.max("prev_n").alias("prev_n"), F.max("cur_n").alias("cur_n"))
    )


def in_band(n: str, low: int = 1, high: int = 3) -> Column:
    return F.coalesce(F.col(n).between(low, high), F.lit(False))


def uplift(bookings: DataFrame, target: float, partner: str = "partner_id", low: int = 1, high: int = 3, step: int = 2) -> DataFrame:
    """Partners with ``low``..``high`` bookings in one month that made at least ``step`` more in the next."""
    base = in_band("prev_n", low, high)
    grew = base & (F.coalesce(F.col("cur_n"), F.lit(0)) >= F.col("prev_n") + step)
    who = F.col(partner)
    counted = booking_pairs(bookings, partner).groupBy("mes_evaluacion").agg(
        F.count(F.when(base, F.lit(1))).alias("_base"),
        F.count(F.when(F.col("prev_n").isNotNull(), who)).alias("agencias_total_previo"),
        F.nullif(F.count(F.when(F.col("cur_n").isNotNull(), who)), F.lit(0)).alias("agencias_total_evaluado"),
        F.count(F.when(base, who)).alias("agencias_1_3_previo"),
        F.count(F.when(grew, who)).alias("agencias_aumentaron"),
    ).where(F.col("_base") > 0)
    return counted.select(
        dates.previous_yyyymm("mes_evaluacion").alias("mes_previo"), "mes_evaluacion", "agencias_total_previo",
        "agencias_total_evaluado", "agencias_1_3_previo", "agencias_aumentaron",
        pct("agencias_aumentaron", "agencias_1_3_previo").alias("pct_aumento"),
        F.lit(target).alias("target_pct"),
        F.round(
            F.col("agencias_aumentaron") * 100.0 / F.nullif(F.col("agencias_1_3_previo").cast("double"), F.lit(0.0))
            / target * 100, 2,
        ).alias("pct_cumplimiento_target"),
    )


def uplift_cumulative(monthly: DataFrame, weekly: DataFrame, partner: str = "partner_id", low: int = 1, high: int = 3, step: int = 2, match_month: bool = False) -> DataFrame:
    """Uplift with the bookings summed up to each week of the evaluated month.

    ``monthly``: mes, partner, reservas; ``weekly``: semana_inicio, mes, partner, reservas. A week in two months joins
    both base groups to the bookings of either month under one row; with ``match_month`` there is a row per (week, month)
    and each base group meets its own month. All inputs are per partner; a month has at most six weeks.
    """
    weeks = weekly.select("semana_inicio", "mes").distinct()
    key = ["semana_inicio", "mes"] if match_month else ["semana_inicio"]
    so_far = (
        weekly.withColumnRenamed("semana_inicio", "_w")
        .join(weeks, "mes")
        .where(F.col("_w") <= F.col("semana_inicio"))
        .groupBy("semana_inicio", "mes", partner)
        .agg(F.sum("reservas").alias("acum"))
    )
    base = (
        monthly.where(F.col("reservas").between(low, high))
        .select(partner, F.col("reservas").alias("_prev"), dates.next_yyyymm("mes").alias("mes"))
        .join(weeks, "mes")
    )
    if not match_month:
        so_far = so_far.groupBy("semana_inicio", partner).agg(F.max("acum").alias("acum"))
        base = base.groupBy("semana_inicio", partner).agg(F.min("_prev").alias("_prev"))
    joined = base.join(so_far, [*key, partner], "left")
    grew = F.coalesce(F.col("acum"), F.lit(0)) >= F.col("_prev") + step
    return joined.groupBy(*key).agg(
        F.count(partner).alias("agencias_1_3_previo"),
        F.count(F.when(grew, F.col(partner))).alias("agencias_aumentaron"),
    ).withColumn("pct_aumento_acum", pct("agencias_aumentaron", "agencias_1_3_previo"))
