"""Grouped counts of entities under conditions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kpiloom.functions.text import column
from kpiloom.operators.ranking import with_places
from kpiloom.operators.tables import inline


def entity_counts(
    df: DataFrame,
    by: Sequence[str],
    counts: Mapping[str, tuple[str, Column | None]],
    sums: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    repeats: Mapping[str, tuple[str, Column | None, int]] | None = None,
    totals: tuple[str, Mapping[str, Column | None]] | None = None,
) -> DataFrame:
    """Exact conditional distinct counts, sums and maxima of one grouping, in one pass over the rows.

    ``counts`` maps an output name to (entity column, predicate). All conditions on one entity are flags that are
    pre-aggregated per (group, entity), so a row is not expanded once per count and a hot group is spread over its
    entities. Several entity columns are handled together by one row per entity kind. NULL entities are not counted;
    their rows still take part in the sums.

    ``repeats`` maps an output name to (actor, predicate, at_least): actors with at least so many distinct
    combinations of the other entity columns, for instance agencies with two bookings. A NULL actor counts as one actor;
    a combination with a NULL does not count.

    ``totals``: one of the columns in ``by``, and the total rows to add under it, each with a predicate on that column (or
    None) that tells which groups it covers. Totals are merged from the rows per (group, entity), never from the input. A
    group that is named like a total only takes part in totals.
    """
    by = list(by)
    sums, maxima, repeats = dict(sums or {}), dict(maxima or {}), dict(repeats or {})
    entities = list(dict.fromkeys(entity for entity, _ in counts.values()))

    def flag(predicate: Column | None) -> Column:
        return F.lit(1) if predicate is None else F.when(predicate, F.lit(1)).otherwise(F.lit(0))

    flags = {out: flag(predicate) for out, (_, predicate) in counts.items()}
    again = {}
    for out, (actor, predicate, _) in repeats.items():
        known = F.lit(True) if predicate is None else predicate
        for entity in entities:
            if entity != actor:
                known = known & column(entity).isNotNull()
        again[out] = flag(known)
    if repeats:
        df = df.groupBy(*by, *entities).agg(
            *[F.max(f).alias(n) for n, f in {**flags, **again}.items()],
            *[F.sum(v).alias(n) for n, v in sums.items()], *[F.max(v).alias(n) for n, v in maxima.items()],
        )
        flags, again, sums, maxima = ({n: F.col(n) for n in part} for part in (flags, again, sums, maxima))
    values = {**sums, **maxima}
    merged = [
        *[F.max(n).alias(n) for n in flags], *[F.sum(n).alias(n) for n in [*again, *sums]], *[F.max(n).alias(n) for n in maxima],
    ]

    def per_entity(rows: DataFrame) -> DataFrame:
        """One row per group and entity (and kind of entity, if there are several)."""
        if len(entities) == 1:
            flat = rows.select(
                *by, column(entities[0]).alias("_id"), *[v.alias(n) for n, v in {**flags, **again, **values}.items()]
            )
            return flat.groupBy(*by, "_id").agg(*merged)
        kinds = []
        for kind, entity in enumerate(entities):
            owned = {n: f if counts[n][0] == entity else F.lit(None).cast("int") for n, f in flags.items()}
            owned |= {n: f if repeats[n][0] == entity else F.lit(None).cast("int") for n, f in again.items()}
            owned |= {n: F.when(F.lit(kind == 0), v) for n, v in values.items()}
            kinds.append(
                F.struct(
                    F.lit(kind).alias("_kind"), column(entity).cast("string").alias("_id"),
                    *[v.alias(n) for n, v in owned.items()],
                )
            )
        return rows.select(*by, F.inline(F.array(*kinds))).groupBy(*by, "_kind", "_id").agg(*merged)

    def counted(entity_rows: DataFrame) -> DataFrame:
        known = [
            F.coalesce(F.sum(F.when(F.col("_id").isNotNull(), F.col(n))), F.lit(0)).cast("long").alias(n) for n in flags
        ]
        repeating = [F.count(F.when(F.col(n) >= repeats[n][2], F.lit(1))).alias(n) for n in again]
        return entity_rows.groupBy(*by).agg(
            *known, *repeating, *[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in maxima]
        )

    partials = per_entity(df)
    if totals is None:
        return counted(partials)
    key, parts = totals
    labels = [F.when(F.lit(True) if chosen is None else chosen, F.lit(label)) for label, chosen in parts.items()]
    label = F.explode(F.array_compact(F.array(*labels)))
    if repeats:  # a combination of entities may lie in several groups, and counts once in the total
        whole = per_entity(
            df.withColumn(key, label).groupBy(*by, *entities).agg(
                *[F.max(n).alias(n) for n in [*flags, *again]], *[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in maxima]
            )
        )
    else:
        whole = partials.withColumn(key, label).groupBy(*by, *[c for c in ("_kind", "_id") if c in partials.columns]).agg(*merged)
    detail = counted(partials).where(F.col(key).isNull() | ~F.col(key).isin(*parts))
    return detail.unionByName(counted(whole))


def keep_total_rows(df: DataFrame, key: str, totals: Sequence[str], zero: Sequence[str] = ()) -> DataFrame:
    """Make sure the total rows exist, as a global aggregate has one row on empty input as well.

    ``df`` is an aggregated result of one row per key.
    """
    spine = inline(df.sparkSession, [(t,) for t in totals], f"{key} string")
    out = df.join(spine, key, "full_outer")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero})


def repeaters(df: DataFrame, by: Sequence[str], actor: str, item: str, at_least: int, out: str) -> DataFrame:
    """Actors with at least so many distinct items, per group: count per actor first, then count the actors."""
    per_actor = df.select(*by, actor, item).distinct().groupBy(*by, actor).agg(F.count(item).alias("_n"))
    return per_actor.groupBy(*by).agg(F.count(F.when(F.col("_n") >= at_least, F.lit(1))).alias(out))


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The k rows with the largest value, the entity id deciding ties."""
    return df.orderBy(F.col(by).desc_nulls_first(), F.col(tie).asc()).limit(k)


def extreme_row(df: DataFrame, by: Sequence[str], value: str, position: str, largest: bool = True) -> DataFrame:
    """Value and position of the largest (smallest) value per group, the earliest position on ties."""
    ranked = df.where(F.col(value).isNotNull()).groupBy(*by)
    sign = -1 if largest else 1
    best = ranked.agg(F.min(F.struct((F.col(value) * sign).alias("v"), F.col(position).alias("p"))).alias("_b"))
    return best.select(*by, (F.col("_b.v") * sign).alias(value), F.col("_b.p").alias(position))


def last_row(df: DataFrame, by: Sequence[str], value: str, position: str) -> DataFrame:
    """Value at the last position per group."""
    last = df.where(F.col(value).isNotNull()).groupBy(*by).agg(
        F.max(F.struct(F.col(position).alias("p"), F.col(value).alias("v"))).alias("_b")
    )
    return last.select(*by, F.col("_b.v").alias(value), F.col("_b.p").alias(position))


def least_squares(df: DataFrame, by: Sequence[str], x: str, y: Column | str) -> DataFrame:
    """Line fit per group, attached to its rows: intercept, slope, residual sd, mean and sum of squares of x, points.

    Rows with a NULL ``y`` are not fitted but get the line too. A group is one short series (a window partition).
    """
    y = column(y)
    group = W.partitionBy(*by)
    fit = df.withColumns(
        {
            "intercept": F.regr_intercept(y, F.col(x)).over(group),
            "slope": F.regr_slope(y, F.col(x)).over(group),
            "sxx": F.regr_sxx(y, F.col(x)).over(group),
            "_syy": F.regr_syy(y, F.col(x)).over(group),
            "_sxy": F.regr_sxy(y, F.col(x)).over(group),
            "mean_x": F.regr_avgx(y, F.col(x)).over(group),
            "n": F.regr_count(y, F.col(x)).over(group),
        }
    )
    residual = F.greatest(F.col("_syy") - F.col("slope") * F.col("_sxy"), F.lit(0.0))
    return fit.withColumn("sd", F.sqrt(residual / F.nullif(F.col("n") - 2, F.lit(0)))).drop("_syy", "_sxy")


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    """Mean with the weights of the non-NULL values only."""
    value, weight = column(value), column(weight)
    return F.sum(value * weight) / F.nullif(F.sum(F.when(value.isNotNull(), weight)), F.lit(0))


#: Names in one chunk of an ordered text.
CHUNK_NAMES = 1000


def packed_chunks(df: DataFrame, by: Sequence[str], name: str, numbers: Sequence[str], order: str, size: int = CHUNK_NAMES) -> DataFrame:
    """Text "name n1 n2;..." per group in numbered chunks of at most ``size`` names, largest ``order`` first, then by name.

    The input holds one aggregated row per (group, name). Names are ranked by a range sort over all groups, so a group of
    any length is spread over tasks; a group without names has one empty chunk.
    """
    text = F.concat_ws(" ", F.col(name), *[F.col(c).cast("string") for c in numbers])
    named = df.where(F.col(name).isNotNull()).select(*by, F.col(order).alias("_o"), F.col(name).alias("_n"), text.alias("_s"))
    placed = with_places(named, [*[F.col(c).asc() for c in by], F.col("_o").desc(), F.col("_n").asc()], "_p")
    entries = F.sort_array(F.collect_list(F.struct("_p", "_s")))
    joined = F.array_join(F.transform(entries, lambda e: e["_s"]), ";").alias("s")
    chunks = placed.groupBy(*by, F.floor((F.col("_p") - 1) / size).alias("_b")).agg(joined)
    first = chunks.groupBy(*[F.col(c).alias(f"_{k}") for k, c in enumerate(by)]).agg(F.min("_b").alias("_first"))
    same = [chunks[c].eqNullSafe(first[f"_{k}"]) for k, c in enumerate(by)]
    numbered = chunks.join(first, same).select(*by, (F.col("_b") - F.col("_first") + 1).alias("chunk"), "s")
    bare = df.groupBy(*by).agg(F.count(name).alias("_n")).where("_n = 0")
    return numbered.unionByName(bare.select(*by, F.lit(1).cast("long").alias("chunk"), F.lit("").alias("s")))


def packed_list(df: DataFrame, by: Sequence[str], name: str, numbers: Sequence[str], order: str) -> DataFrame:
    """The chunks of ``packed_chunks`` as one text per group, for export."""
    chunks = F.sort_array(F.collect_list(F.struct("chunk", "s")))
    return packed_chunks(df, by, name, numbers, order).groupBy(*by).agg(
        F.array_join(F.transform(chunks, lambda c: c["s"]), ";").alias("s")
    )


def member_list(values: Column | str, without: str, separator: str = "+") -> Column:
    """Sorted distinct members of a group but one, as text."""
    members = F.filter(F.collect_set(column(values)), lambda v: v != without)
    return F.array_join(F.array_sort(members), separator)
