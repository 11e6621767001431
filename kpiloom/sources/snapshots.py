"""Result stores: the keyed metric snapshot and the weekly usage store."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions import fixed
from kpiloom.operators.tables import inline
from kpiloom.sources.versions import Part, Store, layout_changes

KEY = "metric_key"


def json_native(df: DataFrame, zero_nulls: bool = False) -> DataFrame:
    """Dates as ISO days, decimals as doubles; optionally NULL numbers as 0."""

    def native(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if zero_nulls and isinstance(f.dataType, T.NumericType):
            c = F.coalesce(c, F.lit(0))
        return c.alias(f.name)

    return df.select(*[native(f) for f in df.schema.fields])


def as_rows(key: str, df: DataFrame) -> DataFrame:
    """A result as (metric_key, row) with the row as JSON text, so all metrics share one layout."""
    body = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row")
    return json_native(df).select(F.lit(key).alias(KEY), body)


def write_snapshot(results: Mapping[str, DataFrame], path: str) -> None:
    """Write all metrics in one job; they replace the snapshot at once."""
    store = Store(SparkSession.active(), path)
    store.publish(_staged(store, results), whole=True)


def refresh_snapshot(results: Mapping[str, DataFrame], path: str, new_layout: bool = False) -> None:
    """Replace the given metrics only, also by no rows; the others stay.

    All results are computed in one job before any counts, and then they count together: a metric that fails, or a run
    that is lost, leaves the snapshot as it was. A metric whose columns differ from those stored fails with their names,
    unless ``new_layout``.
    """
    store = Store(SparkSession.active(), path)
    if not new_layout:
        check_layouts(store, {key: json_native(df).schema for key, df in results.items()})
    store.publish(_staged(store, results))


def check_layouts(store: Store, layouts: Mapping[str, T.StructType]) -> None:
    known = store.parts()
    changed = []
    for key, layout in layouts.items():
        if key in known and known[key].schema:
            changed += [f"{key}.{c}" for c in layout_changes(known[key].struct, layout)]
    if changed:
        raise ValueError(f"columns differ from those stored: {'; '.join(changed)}")


def _staged(store: Store, results: Mapping[str, DataFrame]) -> dict[str, Part]:
    """Rows as JSON text, all in one layout; each part keeps its own schema."""
    if not results:
        raise ValueError("no metric given")
    rows = None
    for key, df in results.items():
        own = as_rows(key, df)
        rows = own if rows is None else rows.unionByName(own)
    parts = store.stage(rows, F.col(KEY), list(results))
    return {key: replace(part, schema=json.dumps(json_native(results[key]).schema.jsonValue())) for key, part in parts.items()}


def snapshot_keys(spark: SparkSession, path: str) -> list[str]:
    return sorted(Store(spark, path).parts())


def read_snapshot(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Rows of one metric in the columns it was stored with; only its folder is read. A metric that failed has no rows."""
    store = Store(spark, path)
    parts = store.parts()
    if key not in parts:
        raise KeyError(f"{key} is not in {path}")
    part = parts[key]
    if not part.folder:
        return spark.createDataFrame([], part.struct)
    rows = spark.read.schema(f"{KEY} string, row string").parquet(f"{store.folder.path}/{part.folder}")
    return rows.select(F.from_json("row", part.struct).alias("r")).select("r.*")


def write_each(builders: Mapping[str, Callable[[], DataFrame]], path: str) -> dict[str, str]:
    """Full build that survives failing metrics: each is written by itself and a failed one is left without rows.

    The metrics count together when all have been tried. Returns "ok" or the error text per metric.
    """
    store = Store(SparkSession.active(), path)  # of this thread, else the default one
    known, parts, status = store.parts(), {}, {}
    for key, build in builders.items():
        try:
            df = build()
            parts |= _staged(store, {key: df})
            status[key] = "ok"
        except Exception as error:  # one metric must not stop the others
            status[key] = f"{type(error).__name__}: {error}"
            parts[key] = Part(None, known[key].schema if key in known else None, {"error": status[key]})
    store.publish(parts)
    return status


def upsert_weeks(store: DataFrame, new: DataFrame, keys: Sequence[str] = ("week_start",)) -> DataFrame:
    """Stored rows with the given weeks replaced by the new ones."""
    kept = store.join(new.select(*keys).distinct(), list(keys), "left_anti").select(store.columns)
    return kept.unionByName(new, allowMissingColumns=True)


def zero_filled(
    weekly: DataFrame, products: Sequence[str], countries: Sequence[str], visits: str = "visits",
    weeks: Sequence[date] | None = None,
) -> DataFrame:
    """A row for every week, product and country; those without data have no filter and 0 visits.

    ``weeks``: the weeks to fill, also those without any row; by default the weeks found.
    """
    spark = weekly.sparkSession
    pairs = inline(spark, [(p, c) for p in products for c in countries], "product string, country string")
    found = weekly.select("week_start").distinct() if weeks is None else inline(spark, [(w,) for w in weeks], "week_start date")
    every = F.array(*[F.lit(p) for p in products])
    full = found.withColumn("product", F.explode(every)).join(pairs, "product")
    out = full.join(weekly, ["week_start", "product", "country"], "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in (visits, "clicks", "thanks")})


def retain_last(store: DataFrame, weeks: int = fixed.WEEKS_KEPT, key: str = "week_start") -> DataFrame:
    """Rows of the latest ``weeks`` weeks."""
    kept = store.select(key).distinct().orderBy(F.col(key).desc()).limit(weeks)
    return store.join(kept, key, "left_semi")


def refresh_weeks(
    store: Store, rows: DataFrame, weeks: Sequence[date], notes: Mapping[date, Mapping] | None = None, keep: int = fixed.WEEKS_KEPT,
    key: str = "week_start",
) -> None:
    """Replace the given weeks by ``rows``, also by none, and let all but the latest ``keep`` weeks go, in one step.

    Only the given weeks are written. Columns that differ from those stored fail with their names.
    """
    names = [w.isoformat() for w in weeks]
    check_layouts(store, {k: rows.schema for k in list(store.parts())[-1:]})
    new = store.stage(rows, F.date_format(key, "yyyy-MM-dd"), names, {w.isoformat(): n for w, n in (notes or {}).items()})
    outdated = sorted({*store.parts(), *names}, reverse=True)[keep:]
    store.publish(new, drop=outdated)


def week_window(store: DataFrame, key: str = "week_start") -> DataFrame:
    """Number of weeks, first day and last day of the store."""
    return store.agg(
        F.count_distinct(key).alias("weeks"), F.min(key).alias("first_day"), F.date_add(F.max(key), 6).alias("last_day")
    )

