"""Staged rollouts: blocks counted from each country's launch, payment mix and linear counterfactual."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import dates, fixed
from kpiloom.functions.numbers import half_even
from kpiloom.operators.aggregate import least_squares
from kpiloom.operators.tables import inline


def launch_table(spark, launches: Mapping[str, date]) -> DataFrame:
    return inline(spark, list(launches.items()), "c string, ld date")


def with_launch(df: DataFrame, launches: Mapping[str, date], country: str = "c", out: str = "ld") -> DataFrame:
    return df.withColumn(out, dates.launch_of(country, launches))


def since_launch(df: DataFrame, launches: Mapping[str, date], day: str = "d", country: str = "c") -> DataFrame:
    """Rows on or after the launch of their country; countries without launch are dropped.

    The bound on the earliest launch is constant, so it reaches the scan.
    """
    launch = dates.launch_of(country, launches)
    return df.where((F.col(day) >= F.lit(min(launches.values()))) & (F.col(day) >= launch))


def with_blocks(df: DataFrame, as_of: date, day: str = "d", launch: str = "ld", out: str = "b") -> DataFrame:
    """Seven-day block of each row, complete blocks only."""
    blocked = df.withColumn(out, dates.block_index(day, launch))
    return blocked.where(dates.block_complete(out, launch, as_of))


def mix_blocks(daily: DataFrame, launches: Mapping[str, date], as_of: date, pre: int = fixed.MIX_PRE_BLOCKS) -> DataFrame:
    """Daily payment mix (d, c, g, n, gb) per block since the launch, ``pre`` blocks before it included.

    Daily counts are added up, so a booking counted on two days counts twice.
    """
    blocked = with_blocks(with_launch(daily, launches), as_of).where(F.col("b") >= -pre)
    return blocked.groupBy("c", "b", "g").agg(
        F.sum("n").alias("n_sum"), half_even(F.sum(F.coalesce(F.col("gb"), F.lit(0.0)))).alias("gb")
    )


def series_blocks(daily: DataFrame, launches: Mapping[str, date], as_of: date, series: Mapping[str, Column]) -> DataFrame:
    """Daily country values per block and named series, in long form: series, c, b, value."""
    blocked = with_blocks(with_launch(daily, launches), as_of)
    long = F.array(
        *[F.struct(F.lit(n).alias("series"), F.coalesce(v.cast("double"), F.lit(0.0)).alias("value")) for n, v in series.items()]
    )
    return blocked.select("c", "b", F.inline(long)).groupBy("series", "c", "b").agg(F.sum("value").alias("value"))


def _fitted(blocks: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Every block from the start of each fit window to the last complete one, missing blocks as 0, with the line fitted
    to the blocks before the launch.

    A series is one row per week of the study, so it is kept as a map while the grid is laid out; ``blocks`` are read once.
    """
    series = blocks.groupBy("series", "c").agg(
        F.max("b").alias("bmax"), F.map_from_entries(F.collect_list(F.struct("b", "value"))).alias("_values")
    ).where(F.col("bmax") >= 0)
    grid = (
        series.select("series", "c", "bmax", "_values", F.explode(F.array(*[F.lit(w) for w in windows])).alias("w"))
        .select("series", "c", "w", "_values", F.explode(F.sequence(-F.col("w"), F.col("bmax"))).alias("b"))
        .select("series", "c", "w", "b", F.coalesce(F.col("_values")[F.col("b")], F.lit(0.0)).alias("value"))
    )
    lines = least_squares(grid, ["series", "c", "w"], "b", F.when(F.col("b") < 0, F.col("value")))
    return lines.withColumn("fit", F.col("intercept") + F.col("slope") * F.col("b"))


def prediction_half_width(quantiles: Mapping[int, float] = fixed.T_QUANTILES, default: float = fixed.T_DEFAULT) -> Column:
    """Half width of the prediction band at block ``b``; 0 before the launch."""
    table = F.create_map(*[F.lit(x) for pair in quantiles.items() for x in pair])
    t = F.coalesce(table[(F.col("n") - 2).cast("int")], F.lit(default))
    spread = F.sqrt(1 + 1 / F.col("n") + F.pow(F.col("b") - F.col("mean_x"), F.lit(2)) / F.col("sxx"))
    return F.when(F.col("b") >= 0, t * F.col("sd") * spread).otherwise(F.lit(0.0))


def counterfactual(blocks: DataFrame, windows: Sequence[int] = fixed.FIT_WINDOWS, main: int = fixed.MAIN_WINDOW) -> DataFrame:
    """Actual, projected line and 80% band per block for the main window.

    ``blocks``: series, c, b, value, already summed up; countries without a complete block since the launch drop out.
    """
    half = prediction_half_width()
    rows = _fitted(blocks, [main])
    return rows.select(
        "series", "c", "b", half_even("value").alias("actual"), half_even("fit").alias("fit"),
        half_even(F.greatest(F.lit(0.0), F.col("fit") - half)).alias("low"), half_even(F.col("fit") + half).alias("high"),
    )


def increments(blocks: DataFrame, windows: Sequence[int] = fixed.FIT_WINDOWS) -> DataFrame:
    """Sum of actual minus projection since the launch, per fit window."""
    rows = _fitted(blocks, windows).where(F.col("b") >= 0)
    return rows.groupBy("series", "c", "w").agg(half_even(F.sum(F.col("value") - F.col("fit"))).alias("increment"))
