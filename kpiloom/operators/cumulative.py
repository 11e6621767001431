"""Month-to-date figures per week.

A running count of distinct entities is the running sum of the entities seen for the first time, so no row is joined
with its predecessors. The widest shuffle is the grouping by (period, entity).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kpiloom.functions.text import column


def first_seen(
    df: DataFrame, period: str, step: str, entity: str, flags: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per (period, entity): its steps, the first one, and the first one under each flag.

    The number of steps in a period is that of the calendar (at most six weeks touch a month).
    """
    marks = {f"first_{name}": F.when(predicate, F.col(step)) for name, predicate in (flags or {}).items()}
    return first_steps(df, period, step, entity, marks)


def first_steps(df: DataFrame, period: str, step: str, entity: str, marks: Mapping[str, Column] | None = None) -> DataFrame:
    """What a running count has to remember: per (period, entity) its steps, the first one, and the least of each mark.

    ``marks`` give a step or NULL per row, for instance the step under a condition. Rows may be added in any number of
    portions, in any order and more than once (``merged_steps``).
    """
    return df.groupBy(period, entity).agg(
        F.collect_set(step).alias("steps"), F.min(step).alias("first"), *[F.min(c).alias(n) for n, c in (marks or {}).items()]
    )


def merged_steps(seen: DataFrame, period: str, entity: str) -> DataFrame:
    """One row per (period, entity) from the rows of several portions."""
    least = [c for c in seen.columns if c not in (period, entity, "steps")]
    return seen.groupBy(period, entity).agg(
        F.array_distinct(F.flatten(F.collect_list("steps"))).alias("steps"), *[F.min(c).alias(c) for c in least]
    )


def cumulate(seen: DataFrame, period: str, step: str, entity: str, flags: Sequence[str] = (), by: str = "period_step") -> DataFrame:
    """Counts per step from ``first_seen`` rows.

    Columns: ``in_step`` (entities in the step itself, ``period_step`` only), ``cumulative`` and ``cumulative_<flag>``.
    ``by="step"`` drops the period from the key: for a step inside two periods, the entities of both are merged.
    """
    seen = seen.where(F.col(period).isNotNull())
    counts = F.col(entity).isNotNull().cast("int")  # a NULL entity only keeps its step on the spine
    names = ["new", *[f"new_{f}" for f in flags]]

    def event(at: Column, shown: int, new: Sequence[Column]) -> Column:
        return F.struct(
            at.alias("_at"), F.lit(shown).alias("_shown"), (counts * shown).alias("in_step"),
            *[(n * counts).alias(name) for n, name in zip(new, names)],
        )

    zero = [F.lit(0)] * len(names)
    shown = F.transform("steps", lambda s: event(s, 1, zero))
    first = [event(F.col("first"), 0, [F.lit(1), *zero[1:]])]
    for i, flag in enumerate(flags):
        marks = list(zero)
        marks[i + 1] = F.lit(1)
        first.append(event(F.col(f"first_{flag}"), 0, marks))
    counted = (
        seen.select(period, F.inline(F.concat(shown, F.array(*first))))
        .where(F.col("_at").isNotNull())
        .groupBy(period, F.col("_at").alias(step))
        .agg(
            F.max("_shown").alias("_shown"), F.sum("in_step").alias("in_step"),
            *[F.sum(n).alias(n) for n in names],
        )
    )
    running = W.partitionBy(period).orderBy(step).rowsBetween(W.unboundedPreceding, 0)
    totals = counted.select(
        period, step, "_shown", "in_step",
        F.sum("new").over(running).alias("cumulative"),
        *[F.sum(f"new_{f}").over(running).alias(f"cumulative_{f}") for f in flags],
    ).where(F.col("_shown") > 0).drop("_shown")
    if by == "period_step":
        return totals
    return _merge_periods(seen, totals, period, step, entity, flags)


def _merge_periods(seen, totals, period, step, entity, flags):
    outs = ["cumulative", *[f"cumulative_{f}" for f in flags]]
    per_step = totals.groupBy(step).agg(F.count("*").alias("_periods"), *[F.max(o).alias(o) for o in outs])
    single = per_step.where(F.col("_periods") == 1).select(step, *outs)
    # Steps inside two periods: only these need the union of both sets, two steps per period at most.
    shared = per_step.where(F.col("_periods") > 1).select(step)
    shared = totals.select(period, F.col(step)).join(shared, step)
    members = (
        # the test on "steps" keeps that column, so this branch reuses the shuffle of the totals
        seen.where(F.size("steps") > 0)
        .select(period, entity, "first", *[f"first_{f}" for f in flags])
        .join(shared, period)
        .where(F.col("first") <= F.col(step))
        .groupBy(step, entity)
        .agg(
            F.lit(1).alias("cumulative"),
            *[
                F.max(F.when(F.col(f"first_{f}") <= F.col(step), 1).otherwise(0)).alias(f"cumulative_{f}")
                for f in flags
            ],
        )
    )
    known = F.col(entity).isNotNull().cast("int")
    return single.unionByName(members.groupBy(step).agg(*[F.sum(F.col(o) * known).alias(o) for o in outs]))


def cumulative_distinct(
    df: DataFrame, period: str, step: str, entity: str, flags: Mapping[str, Column] | None = None,
    by: str = "period_step",
) -> DataFrame:
    """Distinct entities up to each step of its period, in all and under each flag."""
    flags = dict(flags or {})
    seen = first_seen(df, period, step, entity, flags)
    return cumulate(seen, period, step, entity, list(flags), by)


def cumulative_sum(df: DataFrame, period: str, step: str, value: Column | str, by: str = "period_step") -> DataFrame:
    """Running sum inside the period; ``by="step"`` adds up the periods that share a step."""
    sums = df.groupBy(period, step).agg(F.sum(column(value)).alias("in_step"))
    running = W.partitionBy(period).orderBy(step).rowsBetween(W.unboundedPreceding, 0)
    out = sums.withColumn("cumulative", F.sum("in_step").over(running))
    if by == "period_step":
        return out
    return out.groupBy(step).agg(F.sum("in_step").alias("in_step"), F.sum("cumulative").alias("cumulative"))


def step_values(df: DataFrame, period: str, step: str, values: Sequence[str]) -> DataFrame:
    """Value of each step from a cumulative one, starting again with every period. Input is an aggregated series."""
    order = W.partitionBy(period).orderBy(step)
    return df.withColumns({v: F.col(v) - F.coalesce(F.lag(v).over(order), F.lit(0)) for v in values})


def worsening(df: DataFrame, series: str, step: str, value: str, lower_is_better: Column | str) -> DataFrame:
    """Last values of each weekly series and whether it got worse twice in a row.

    Input is an aggregated series per metric; series with fewer than two values are left out.
    """
    inverted = column(lower_is_better)
    order = W.partitionBy(series).orderBy(step)
    lagged = df.where(F.col(value).isNotNull()).select(
        series, inverted.alias("inv"), F.col(value).alias("last"),
        F.lag(value, 1).over(order).alias("prev"), F.lag(value, 2).over(order).alias("prev2"),
        F.row_number().over(W.partitionBy(series).orderBy(F.col(step).desc())).alias("_rn"),
    )

    def worse(a: Column, b: Column) -> Column:
        return F.when(F.col("inv"), a > b).otherwise(a < b)

    last, prev, prev2 = F.col("last"), F.col("prev"), F.col("prev2")
    return lagged.where((F.col("_rn") == 1) & prev.isNotNull()).select(
        series, "last", "prev", "inv",
        F.when(F.col("inv"), last < prev).otherwise(last > prev).alias("up"),
        F.coalesce(worse(last, prev) & worse(prev, prev2), F.lit(False)).alias("declining"),
    )


def mean_without_latest(df: DataFrame, series: str, step: str, value: str) -> DataFrame:
    """Mean of all but the latest step per series, 0 where there is no other. Input is an aggregated series."""
    rank = F.row_number().over(W.partitionBy(series).orderBy(F.col(step).desc()))
    ranked = df.where(F.col(value).isNotNull()).withColumn("_rn", rank)
    return ranked.groupBy(series).agg(
        F.coalesce(F.avg(F.when(F.col("_rn") > 1, F.col(value))), F.lit(0.0)).alias("mean_complete")
    )
