"""The registered queries and their comparison SQL, by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import board_queries, operator_queries
from checks import metric_sql as M
from checks import roles as R
from kpiloom.operators import funnel
from kpiloom.plans import first_half, initiatives, registry
from kpiloom.plans.settings import Settings

Query = Callable[[SparkSession, str], DataFrame]


def metric(function, settings: Settings) -> Query:
    return lambda spark, sf_dir: function(R.roles(spark, sf_dir), settings)


def metric_queries() -> dict[str, Query]:
    out: dict[str, Query] = {f"h1_{k}": metric(f, R.FIRST) for k, f in registry.FIRST_HALF.items()}
    out |= {f"h2_{k}": metric(f, R.SECOND) for k, f in registry.SECOND_HALF.items() if not k.endswith("_prog")}
    out |= {k: metric(f, R.IMPACT) for k, f in registry.INITIATIVES.items() if k != "gv_ctr"}
    out |= {
        f"gv_ctr_{g}": metric(lambda t, s, g=g: initiatives.gv_ctr(t, s, g), R.CLICKS) for g in ("d", "w", "m", "t")
    }
    out["h1_kr31_forecast"] = metric(lambda t, s: first_half.kr31(t, s, ("FCST",), align_services=True), R.FIRST)
    out["filter_usage"] = metric(board_queries.usage, R.CLICKS)
    out["filter_usage_total"] = metric(lambda t, s: funnel.usage_totals(board_queries.usage(t, s)), R.CLICKS)
    out["filter_usage_text"] = metric(lambda t, s: funnel.packed_usage(board_queries.usage(t, s)), R.CLICKS)
    return out


def metric_sql() -> dict[str, str]:
    out = {f"h1_{k}": v for k, v in M.FIRST.items()}
    out |= {f"h2_{k}": v for k, v in M.SECOND.items()}
    out |= M.INITIATIVES
    out |= M.CLICKS
    out["h1_kr31_forecast"] = M.kr31(("FCST",), "Dest. Serv.")
    return out


def queries() -> dict[str, Query]:
    return metric_queries() | board_queries.pairs.queries | operator_queries.pairs.queries


def oracle_sql() -> dict[str, str]:
    return metric_sql() | board_queries.pairs.sql | operator_queries.pairs.sql
