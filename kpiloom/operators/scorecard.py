"""Scorecards: attainment of monthly targets, weighted totals, progress and monitor figures.

Inputs are long tables of metric results: ``actuals`` (id, month, actual), ``targets`` (id, month, target) and
``board`` (id, ord, squad, weight, inverted), month as ``yyyy-MM`` text. All of them are aggregated results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kpiloom.functions import fixed
from kpiloom.functions.text import column
from kpiloom.operators.aggregate import weighted_mean
from kpiloom.operators.tables import inline


def board_table(spark: SparkSession, board=fixed.FIRST_HALF_BOARD) -> DataFrame:
    rows = [(b[0], i, b[1], float(b[2]), b[3]) for i, b in enumerate(board)]
    return inline(spark, rows, "id string, ord int, squad string, weight double, inverted boolean")


def target_table(spark: SparkSession, months: Sequence[str], board=fixed.FIRST_HALF_BOARD) -> DataFrame:
    """Constant targets in long form, with the quarter of each month inside the half."""
    rows = [
        (b[0], month, "q1" if i < 3 else "q2", float(b[4][i])) for b in board for i, month in enumerate(months)
    ]
    return inline(spark, rows, "id string, month string, quarter string, target double")


def actuals_long(metrics: Mapping[str, tuple[DataFrame, Column, Column]]) -> DataFrame:
    """Results of several metrics as (id, month, actual): per metric its rows, month key and value."""
    out = None
    for key, (rows, month, value) in metrics.items():
        part = rows.select(F.lit(key).alias("id"), F.substring(month.cast("string"), 1, 7).alias("month"), value.cast("double").alias("actual"))
        out = part if out is None else out.unionByName(part)
    return out


def row_targets(constants: DataFrame, rows: DataFrame) -> DataFrame:
    """Target of the metric's own rows where there is one, else the constant. ``rows``: id, month, target."""
    own = rows.select("id", "month", F.col("target").cast("double").alias("_own"))
    return constants.join(own, ["id", "month"], "left").withColumn("target", F.coalesce("_own", "target")).drop("_own")


def timeout_share(rows: DataFrame) -> DataFrame:
    """Time-out share of all statuses per deadline month, from the reservations-by-status rows."""
    return rows.groupBy("mes_deadline").agg(
        (
            F.sum(F.when(F.col("status") == fixed.TIMEOUT_STATUS, F.col("reservas")).otherwise(F.lit(0)))
            * F.lit(100.0) / F.nullif(F.sum("reservas"), F.lit(0))
        ).alias("pct_timeout")
    )


def attainment(actual: Column | str, target: Column | str, inverted: Column | str) -> Column:
    """Actual in percent of the target, or the other way round where lower is better.

    NULL without actual or target or with a zero target. A zero actual of a lower-is-better metric is unbounded in
    theory; it counts as the cap.
    """
    a, t = column(actual).cast("double"), column(target).cast("double")
    down = F.when(a == 0, F.lit(fixed.CAP)).otherwise(t / F.nullif(a, F.lit(0.0)) * 100)
    up = a / F.nullif(t, F.lit(0.0)) * 100
    return F.when(a.isNull() | t.isNull() | (t == 0), F.lit(None)).when(column(inverted), down).otherwise(up)


def effective(pct: Column | str) -> Column:
    """Attainment that counts: 0 below the floor, cut at the cap."""
    p = column(pct)
    return F.when(p < fixed.FLOOR, F.lit(0.0)).when(p > fixed.CAP, F.lit(fixed.CAP)).otherwise(p)


def band(pct: Column | str) -> Column:
    e = effective(pct)
    return F.when(e.isNull(), "na").when(e >= fixed.GOOD, "ok").when(e >= fixed.NEAR, "warn").otherwise("bad")


def band_note(pct: Column | str) -> Column:
    p = column(pct)
    return F.when(p < fixed.FLOOR, "floored").when(p > fixed.CAP, "capped")


def squad_filter(board: DataFrame, squad: str | None = None) -> DataFrame:
    return board if squad is None else board.where(F.col("squad") == squad)


def month_scores(board: DataFrame, targets: DataFrame, actuals: DataFrame, as_of: date, closed_only: bool = True) -> DataFrame:
    """Actual, target, attainment and band of every metric and month.

    ``closed_only`` scores finished months only and shows the actual of the current one; otherwise the current month is
    scored too and tagged as partial.
    """
    current = as_of.strftime("%Y-%m")
    month = F.col("month")
    scored = (month < current) if closed_only else (month <= current)
    rows = targets.join(board, "id").join(actuals, ["id", "month"], "left")
    out = rows.withColumns(
        {
            "actual": F.when(month <= current, F.col("actual")),
            "pct": F.when(scored, attainment("actual", "target", "inverted")),
        }
    )
    return out.withColumns(
        {
            "effective": effective("pct"),
            "band": F.when(scored, band("pct")),
            "note": band_note("pct"),
            "partial": F.lit(not closed_only) & (month == current) & F.col("pct").isNotNull(),
        }
    )


def span_means(scores: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean of the non-NULL months per quarter and for the half, NULL where there is none."""
    keyed = scores.withColumn("span", F.explode(F.array(F.col("quarter"), F.lit("half"))))
    return keyed.groupBy(*by, "span").agg(F.avg(value).alias(value))


def weighted_months(scores: DataFrame) -> DataFrame:
    """Weighted capped attainment per month; the weights of metrics without a score do not count."""
    return scores.groupBy("month", "quarter").agg(weighted_mean("effective", "weight").alias("pct"))


def weighted_total(scores: DataFrame) -> DataFrame:
    """Weighted months and their quarter and half means, as (period, pct)."""
    periods = F.explode(F.array(F.col("month"), F.col("quarter"), F.lit("half")))
    return weighted_months(scores).select(periods.alias("period"), "pct").groupBy("period").agg(F.avg("pct").alias("pct"))


def weight_shares(board: DataFrame, fill_last: bool = True) -> DataFrame:
    """Weight in percent with one decimal; with ``fill_last`` the last one is what is left to 100, else 0 gives NULL."""
    everything = W.partitionBy(F.lit(1))  # the board has a handful of rows
    total = F.sum("weight").over(everything)
    share = F.round(F.col("weight") / F.nullif(total, F.lit(0.0)) * 100, 1)
    if not fill_last:
        return board.select("id", "ord", F.when(F.col("weight") > 0, share).alias("share"))
    last = F.row_number().over(everything.orderBy(F.col("ord").desc())) == 1
    parts = board.select("id", "ord", share.alias("_s"), last.alias("_last"))
    others = F.sum(F.when(~F.col("_last"), F.col("_s")).otherwise(0.0)).over(everything)
    return parts.select("id", "ord", F.when(F.col("_last"), F.round(100 - others, 1)).otherwise(F.col("_s")).alias("share"))


def progress(board: DataFrame, targets: DataFrame, actuals: DataFrame, as_of: date) -> DataFrame:
    """State of the latest month: attainment, signed distance to the target, whether it is met and the bar length."""
    current = as_of.strftime("%Y-%m")
    latest = targets.where(F.col("month") <= current).agg(F.max("month")).scalar()
    first = targets.agg(F.min("month")).scalar()
    rows = targets.where(F.col("month") == F.coalesce(latest, first)).join(board, "id").join(actuals, ["id", "month"], "left")
    delta = F.when(F.col("inverted"), F.col("target") - F.col("actual")).otherwise(F.col("actual") - F.col("target"))
    pct = attainment("actual", "target", "inverted")
    return rows.select(
        "id", "month", "actual", "target", pct.alias("pct"), delta.alias("delta"), (delta >= 0).alias("good"),
        band(pct).alias("band"), F.when(pct.isNull(), F.lit(0.0)).otherwise(F.least(pct, F.lit(100.0))).alias("bar"),
    )


def weekly_attainment(cumulative: DataFrame, targets: DataFrame, board: DataFrame, as_of: date, first_month: str) -> DataFrame:
    """Month-to-date value of each metric and week against the target of the month of that week.

    ``cumulative``: id, semana_inicio, value. Weeks from the first month up to the one before the current Monday.
    """
    week = F.col("semana_inicio")
    month = F.date_format(week, "yyyy-MM")
    shown = cumulative.where(week.isNotNull() & (month >= first_month) & (week < F.trunc(F.lit(as_of), "week")))
    rows = shown.withColumn("month", month).join(targets, ["id", "month"], "left").join(board, "id")
    pct = attainment("value", "target", "inverted")
    return rows.select(
        "id", "semana_inicio", "month", "value", "target", pct.alias("pct"),
        F.when(pct.isNull(), "na").when(pct >= fixed.GOOD, "ok").when(pct >= fixed.NEAR, "warn").otherwise("bad").alias("band"),
    )


def month_filter(rows: DataFrame, month: str | None, step: str = "semana_inicio") -> DataFrame:
    """Weekly rows of one month, all of them without a month."""
    return rows if month is None else rows.where(F.date_format(F.col(step), "yyyy-MM") == month)


def monitor_cards(weekly: DataFrame, targets: DataFrame, step: str = "semana_inicio") -> DataFrame:
    """Per metric: highest and lowest week, last week, its target, the gap, weeks present in that month and means.

    ``weekly``: id, semana_inicio, value - an aggregated series per metric. Ties go to the earliest week.
    """
    rows = weekly.where(F.col("value").isNotNull())
    at = F.col(step)
    later = F.date_diff(F.lit(date(9999, 12, 31)), at)
    cards = rows.groupBy("id").agg(
        F.max("value").alias("best"),
        F.max_by(at, F.struct("value", later)).alias("best_week"),
        F.min("value").alias("worst"),
        F.min_by(at, F.struct("value", at)).alias("worst_week"),
        F.max_by("value", at).alias("last"),
        F.max(at).alias("last_week"),
        F.avg("value").alias("mean"),
    ).withColumn("month", F.date_format("last_week", "yyyy-MM"))
    present = rows.select("id", F.date_format(at, "yyyy-MM").alias("month"), at).distinct().groupBy("id", "month").agg(
        F.count("*").alias("weeks_in_month")
    )
    latest_first = W.partitionBy("id").orderBy(at.desc())
    complete = rows.withColumn("_rn", F.row_number().over(latest_first)).groupBy("id").agg(
        F.coalesce(F.avg(F.when(F.col("_rn") > 1, F.col("value"))), F.lit(0.0)).alias("mean_complete")
    )
    return (
        cards.join(present, ["id", "month"], "left").join(complete, "id")
        .join(targets.select("id", "month", "target"), ["id", "month"], "left")
        .withColumns(
            {"gap": F.col("last") - F.col("target"), "mean_gap": F.col("mean") - F.lit(fixed.ACTIVATION_REFERENCE)}
        )
    )


def frequency_cards(monthly: DataFrame, as_of: date, target: float = fixed.MONITOR_UPLIFT_TARGET) -> DataFrame:
    """Best and last evaluated month of the uplift, and the value of the current month if there is one.

    ``monthly``: mes_evaluacion (yyyymm), pct_aumento. The last row stands for the current month as well.
    """
    now = as_of.year * 100 + as_of.month
    month, value = F.col("mes_evaluacion"), F.col("pct_aumento")
    cards = monthly.agg(
        F.max(value).alias("best"),
        F.max_by(month, F.struct(value, -month)).alias("best_month"),
        F.max_by(value, month).alias("last"),
        F.max(month).alias("last_month"),
        F.max((month == now).cast("int")).alias("has_current"),
    )
    return cards.select(
        "best", "best_month", "last", "last_month", (F.col("last") >= target).alias("last_good"),
        F.when(F.col("has_current") == 1, F.col("last")).otherwise(F.lit(0.0)).alias("current"),
    )


def chart_series(weekly: DataFrame, cumulative: DataFrame, targets: DataFrame) -> DataFrame:
    """Weekly value, month-to-date value and monthly target side by side, per metric and week."""
    weeks = weekly.select("id", "semana_inicio", "value", F.date_format("semana_inicio", "yyyy-MM").alias("month"))
    return weeks.join(
        cumulative.select("id", "semana_inicio", F.col("value").alias("cumulative")), ["id", "semana_inicio"], "left"
    ).join(targets.select("id", "month", "target"), ["id", "month"], "left")
