"""Filter usability: how many search visits use each filter, and how many of them buy."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from kpiloom.operators import funnel
from kpiloom.plans.settings import Settings
from kpiloom.sources.tables import Tables


def filter_clicks(t: Tables, since: date, until: date) -> DataFrame:
    """Filter clicks of all four event tables in one relation."""
    parts = [
        funnel.clicks_from_map(t.map_a_events, "map_a", since, until),
        funnel.clicks_from_map(t.map_b_events, "map_b", since, until),
        funnel.clicks_from_array(t.array_events, "array", since, until),
        funnel.clicks_from_label(t.label_events, "label", since, until),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def filter_usage(t: Tables, s: Settings, since: date, until: date) -> DataFrame:
    """Usage per product, week, country and filter for whole weeks ``since``..``until``."""
    return funnel.filter_usage(t.traffic, filter_clicks(t, since, until), s.channels, s.anchor, since, until)


def filter_usage_total(t: Tables, s: Settings, since: date, until: date) -> DataFrame:
    """Usage per product and week, summed over the countries."""
    return funnel.usage_totals(filter_usage(t, s, since, until))
