"""Click funnels over page views and filter events.

Four event shapes are brought to one relation (source, week_start, pageview_id, filter_name) and made distinct before
they meet the page views, so repeated events and repeated page views multiply nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import dates, fixed
from kpiloom.functions.text import recode
from kpiloom.operators.aggregate import packed_list
from kpiloom.operators.calendar import by_grains, period_of


def in_window(events: DataFrame, since: date, until: date) -> DataFrame:
    """Events of the days ``since``..``until``, compared as ISO text so the bound reaches the scan."""
    return events.where(F.col("datetime").between(since.isoformat(), f"{until.isoformat()}T23:59:59.999"))


def _distinct_clicks(events: DataFrame, source: str, name: str) -> DataFrame:
    return events.select(
        F.lit(source).alias("source"), F.to_date(dates.iso_day("datetime")).alias("d"),
        F.col("event.pageview_id").alias("pageview_id"), F.col(name).alias("filter_name"),
    ).distinct()


def clicks_from_map(events: DataFrame, source: str, since: date, until: date) -> DataFrame:
    """Map shape: every filter name that carries at least one value."""
    flat = in_window(events, since, until).select(
        "datetime", "event.pageview_id", F.explode("event.filters").alias("filter_name", "_values")
    )
    return _distinct_clicks(
        flat.where(F.size("_values") > 0).withColumn("event", F.struct("pageview_id")), source, "filter_name"
    )


def clicks_from_array(events: DataFrame, source: str, since: date, until: date) -> DataFrame:
    """Array shape: selected filters with at least one value."""
    chosen = (F.col("event.type") == "filter") & (F.col("event.selected") == "1") & (F.size("event.event.values") > 0)
    return _distinct_clicks(in_window(events, since, until).where(chosen), source, "event.event.name")


def clicks_from_label(events: DataFrame, source: str, since: date, until: date) -> DataFrame:
    """Label shape: applied labels other than sorting, with a filter in the data."""
    chosen = (
        (F.col("event.action") == "apply")
        & ~F.col("event.label").isin(*fixed.NOT_FILTER_LABELS)
        & F.element_at("event.data", F.lit("filter")).isNotNull()
    )
    return _distinct_clicks(in_window(events, since, until).where(chosen), source, "event.label")


def clean_pages(traffic: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Real page views of the given channels."""
    return traffic.where(
        (F.col("ispageview") == 1) & (F.col("flg_detalle_cp") == 0) & (F.col("is_bot") == 0) & F.col("channel").isin(*channels)
    )


def country_group(country: Column | str) -> Column:
    c = F.col(country) if isinstance(country, str) else country
    return F.when(c.isin(*fixed.USAGE_COUNTRIES), c).otherwise(fixed.OTHER_USAGE_COUNTRY)


#: Stands for a missing id among page views, so that branches of the plan add no filters of their own and share reads.
NO_ID = "\u0000"


def _usage_pages(traffic: DataFrame, channels: Sequence[str], anchor: date, since: date, until: date) -> DataFrame:
    labels = {k: v[0] for k, v in fixed.USAGE_PRODUCTS.items()}
    sources = {k: v[1] for k, v in fixed.USAGE_PRODUCTS.items()}
    pages = clean_pages(traffic, channels).where(
        F.col("product").isin(*fixed.USAGE_PRODUCTS) & F.col("flow").isin("SEARCH", "THANKS")
        & F.col("date").between(since.isoformat(), until.isoformat())
    )
    named = pages.select(
        recode("product", labels).alias("product"), recode("product", sources).alias("source"),
        period_of(F.to_date("date"), anchor).alias("week_start"), country_group("country").alias("cg"),
        *[F.coalesce(F.col(c), F.lit(NO_ID)).alias(c) for c in ("visit", "pageview_id")], "flow",
    )
    return named.where(F.col("product").isNotNull() & F.col("source").isNotNull() & F.col("week_start").isNotNull())


def filter_usage(
    traffic: DataFrame, clicks: DataFrame, channels: Sequence[str], anchor: date, since: date, until: date
) -> DataFrame:
    """Search visits and, per filter, the visits that used it and those of them that reached the thank-you page.

    All products and all weeks from ``since`` (a week start) to ``until`` (the last day of a week) in one pass.
    ``clicks`` is the union of the normalised events. A week without any click has one row with a NULL filter.
    """
    pages = _usage_pages(traffic, channels, anchor, since, until)
    key = ["product", "week_start", "cg"]
    # what a visit did, as bits: 1 searched, 2 reached the thank-you page; both groupings are used twice and shared
    flow = F.when(F.col("flow") == "SEARCH", 1).otherwise(2)
    views = pages.groupBy(*key, "source", "visit", "pageview_id").agg(F.bit_or(flow).alias("did"))
    visited = views.groupBy(*key, "visit").agg(F.bit_or("did").alias("did"))
    searched, thanked = F.col("did").bitwiseAND(1) > 0, F.col("did").bitwiseAND(2) > 0
    known = F.col("visit") != NO_ID
    used = clicks.where(F.col("d").between(F.lit(since), F.lit(until)) & F.col("pageview_id").isNotNull()).select(
        "source", period_of("d", anchor).alias("week_start"), "pageview_id", "filter_name"
    ).distinct()
    using = views.where(searched).join(used, ["source", "week_start", "pageview_id"]).select(*key, "filter_name", "visit").distinct()
    per_filter = (
        using.join(visited, [*key, "visit"], "left").groupBy(*key, "filter_name")
        .agg(F.count(F.when(known, 1)).alias("clicks"), F.count(F.when(known & thanked, 1)).alias("thanks"))
    )
    visits = visited.where(searched).groupBy(*key).agg(F.count(F.when(known, 1)).alias("visits"))
    return visits.join(per_filter, key, "left").select(
        "product", "week_start", F.col("cg").alias("country"), "visits", "filter_name",
        F.coalesce("clicks", F.lit(0)).alias("clicks"), F.coalesce("thanks", F.lit(0)).alias("thanks"),
    )


def usage_totals(usage: DataFrame) -> DataFrame:
    """Product totals per week: sums over the countries, which are not distinct again. Input is the aggregated usage."""
    visits = usage.select("product", "week_start", "country", "visits").distinct().groupBy("product", "week_start").agg(
        F.sum("visits").alias("visits_sum")
    )
    filters = usage.groupBy("product", "week_start", "filter_name").agg(
        F.sum("clicks").alias("clicks_sum"), F.sum("thanks").alias("thanks_sum")
    )
    kept = filters.where(F.col("filter_name").isNotNull())
    return visits.join(kept, ["product", "week_start"], "left")


def packed_usage(usage: DataFrame) -> DataFrame:
    """Stored text form per product, week and country: "filter clicks thanks;..." by falling clicks."""
    return packed_list(usage, ["product", "week_start", "country", "visits"], "filter_name", ["clicks", "thanks"], "clicks")


def click_through(
    traffic: DataFrame, events: DataFrame, channels: Sequence[str], countries: Sequence[str], launch: date,
    grains: Sequence[str] = ("d", "w", "m", "t"),
) -> DataFrame:
    """Visits that were shown the price grid and clicked in it, per time grain and country.

    A visit counts once per period, so the grains are not additive; they come from one scan. Events are reduced to one
    row of flags per page view and day before they meet the page views.
    """
    pages = clean_pages(traffic, channels).where(
        (F.col("product") == "FLIGHTS") & (F.col("flow") == "SEARCH") & (F.col("date") >= launch.isoformat())
        & F.col("pageview_id").isNotNull()
    ).select("pageview_id", "visit").distinct()
    kind, code = F.col("event.type"), F.col("event.code")
    marks = {
        "s": (kind == "show") & (code == fixed.GRID_SHOW),
        "ct": (kind == "click") & (code == fixed.GRID_SHOW),
        "ca": (kind == "click") & (code == fixed.GRID_TAB),
        "cc": (kind == "click") & (code == fixed.GRID_CHEAPEST),
    }
    flags = [F.max(F.when(predicate, 1).otherwise(0)).alias(name) for name, predicate in marks.items()]
    merged = [F.max(name).alias(name) for name in marks]
    shown = (
        events.where(
            (F.col("datetime") >= launch.isoformat()) & (F.col("event.fl") == "search") & kind.isin("show", "click")
            & code.isin(fixed.GRID_SHOW, fixed.GRID_TAB, fixed.GRID_CHEAPEST)
            & F.col("event.cc").isin(*countries) & F.col("event.ft").isin("ONEWAY", "ROUNDTRIP")
        )
        .groupBy(
            F.col("event.pageview_id").alias("pageview_id"), F.col("event.cc").alias("c"),
            F.to_date(dates.iso_day("datetime")).alias("day"),
        )
        .agg(*flags)
    )
    visits = pages.join(shown, "pageview_id")
    per_day = visits.groupBy("day", "c", "visit").agg(*merged)
    per_visit = by_grains(per_day, "day", grains).groupBy("grain", "p", "c", "visit").agg(*merged)
    return per_visit.where(F.col("s") == 1).groupBy("grain", "p", "c").agg(
        F.sum("s").alias("shows"), F.sum("ct").alias("c_tab"), F.sum("ca").alias("c_any"), F.sum("cc").alias("c_cheap")
    )
