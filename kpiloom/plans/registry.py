"""Metric names, the function behind each, and the refresh groups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.ranking import with_places
from kpiloom.plans import first_half, initiatives, second_half
from kpiloom.plans.settings import Settings
from kpiloom.session import scratch_path
from kpiloom.sources import snapshots
from kpiloom.sources.tables import Tables

Metric = Callable[..., DataFrame]  # of the tables and the settings

FIRST_HALF: dict[str, Metric] = {
    name: getattr(first_half, name)
    for name in (
        "kr21", "kr22", "kr31", "kr32", "kr33", "kr21_sem", "kr21_sem_cum", "kr22_sem", "kr22_sem_cum", "kr31_sem",
        "kr31_sem_cum", "kr32_sem", "kr32_sem_cum", "kr33_sem", "kr33_sem_cum",
    )
}
# The *_prog keys hold the same figures under a key of their own, refreshed daily.
SECOND_HALF: dict[str, Metric] = {
    "kr11": second_half.kr11, "kr11_prog": second_half.kr11, "kr21": second_half.kr21, "kr22": second_half.kr22,
    "kr21_prog": second_half.kr21, "kr22_prog": second_half.kr22, "kr21_sem": second_half.kr21_sem,
    "kr22_sem": second_half.kr22_sem,
}
INITIATIVES: dict[str, Metric] = {
    name: getattr(initiatives, name)
    for name in (
        "ldp_daily", "ldp_country", "ldp_totals", "ldp_top", "ldp_mix", "cf_daily", "pd_daily", "pkg_daily", "wallet_daily",
        "gv_daily", "pp_a", "pp_m", "pp_x", "pp_ctl", "pp_ag", "pp_agw", "gv_ctr", "wallet_agencies", "wallet_mix",
    )
}
# Row order of each result. Metrics return unordered rows; whoever shows them sorts the few that are left.
ORDER: dict[str, tuple[str, ...]] = {
    "h1.kr21": ("mes_deadline", "status"), "h1.kr22": ("creation_yearmonth",), "h1.kr31": ("periodo",), "h1.kr32": ("mes",),
    "h1.kr33": ("mes_previo",), "h1.kr21_sem_cum": ("semana_inicio", "mes_deadline"),
    **{f"h1.{k}": ("semana_inicio",) for k in FIRST_HALF if "_sem" in k and k != "kr21_sem_cum"},
    "h2.kr11": ("mes",), "h2.kr21": ("mes",), "h2.kr22": ("mes_comercial",), "h2.kr21_sem": ("semana_inicio", "mes"),
    "h2.kr22_sem": ("mes_comercial", "semana"), "ldp_daily": ("d", "c"), "wallet_daily": ("d", "c"), "pd_daily": ("d",),
    "pp_agw": ("w",), "gv_ctr": ("grain", "p", "c"),
    # a leading minus: falling
    "filter_usage": ("product", "week_start", "country", "-clicks", "filter_name"),
    "filter_usage_text": ("-visits", "product", "week_start", "country"),
    "filter_usage_total": ("product", "week_start", "-clicks_sum", "filter_name"),
}


def order_of(key: str) -> list[Column]:
    """Sort columns of a report; none where it has no order."""
    names = ORDER.get(key.removesuffix("_prog"), ())
    return [F.col(n[1:]).desc() if n.startswith("-") else F.col(n).asc() for n in names]


def ordered(key: str, rows: DataFrame) -> DataFrame:
    """Rows in the order of their report; results without one are left as they are."""
    order = order_of(key)
    return rows.orderBy(*order) if order else rows


def numbered(key: str, rows: DataFrame) -> DataFrame:
    """Rows of a report with their place in it, from 1. Usage reports grow with labels and weeks, so no task gets all rows."""
    return with_places(rows, order_of(key), "position")


CADENCES: dict[str, tuple[str, ...]] = {
    "diario": ("kr11_prog", "kr21_prog", "kr22_prog"),
    "semanal": ("kr21_sem", "kr22_sem"),
    "mensual": ("kr11", "kr21", "kr22"),
}


def keys_of(mode: str) -> list[str]:
    """Second-half metrics of a cadence; "todo" and "auto" mean all of them."""
    groups = CADENCES if mode in ("todo", "auto") else [mode]
    return [key for group in groups for key in CADENCES[group]]


#: The base of a metric, by its function; each is stored once for all metrics of a run that share it.
BASES: dict[Metric, Metric] = {
    getattr(module, name): base for module in (first_half, initiatives) for name, base in module.BASES.items()
}
NARROW: dict[Metric, Metric] = {getattr(first_half, name): base for name, base in first_half.NARROW.items()}
REPEATED: set[Metric] = {getattr(first_half, name) for name in first_half.REPEATED}


class Shared:
    """Metrics of one run, with the bases that two or more of them share, or one reads several times; a base is stored
    when it is first asked for."""

    def __init__(self, metrics: Mapping[str, Metric], keys: Iterable[str], t: Tables, s: Settings) -> None:
        self.metrics, self.t, self.s = metrics, t, s
        families: dict[Metric, set[Metric]] = {}
        for m in {metrics[k] for k in keys}:
            if m in BASES:
                families.setdefault(BASES[m], set()).add(m)
        self.bases: dict[Metric, Metric] = {}
        for base, family in families.items():
            if len(family) > 1 or family & REPEATED:
                narrow = {NARROW.get(m, base) for m in family}
                self.bases |= dict.fromkeys(family, narrow.pop() if len(narrow) == 1 else base)
        self.locks = {base: Lock() for base in self.bases.values()}
        self.stored: dict[Metric, DataFrame] = {}

    def rows(self, key: str) -> DataFrame:
        metric = self.metrics[key]
        base = self.bases.get(metric)
        return metric(self.t, self.s, base=self.base(base)) if base else metric(self.t, self.s)

    def spread(self, keys: Iterable[str]) -> list[str]:
        """The keys, with one metric of each base in front, so that no base is waited for while others could be computed."""
        first: dict[Metric, str] = {}
        for key in (keys := list(keys)):
            first.setdefault(self.bases.get(self.metrics[key], self.metrics[key]), key)
        return [*first.values(), *(k for k in keys if k not in first.values())]

    def base(self, base: Metric) -> DataFrame:
        with self.locks[base]:
            if base not in self.stored:
                spark = SparkSession.active()
                rows, path = base(self.t, self.s), scratch_path(spark, base.__name__)
                rows.write.parquet(path)
                self.stored[base] = spark.read.schema(rows.schema).parquet(path)
            return self.stored[base]


def run(metrics: Mapping[str, Metric], keys: Iterable[str], t: Tables, s: Settings) -> dict[str, DataFrame]:
    """The plans of the chosen metrics; only shared bases are computed before they are written."""
    keys = list(keys)
    shared = Shared(metrics, keys, t, s)
    return {key: shared.rows(key) for key in keys}


def refresh(mode: str, t: Tables, s: Settings, path: str) -> None:
    """Recompute the second-half metrics of a cadence and replace just those in the snapshot."""
    snapshots.refresh_snapshot(run(SECOND_HALF, keys_of(mode), t, s), path)


def stored(metrics: Mapping[str, Metric], keys: Iterable[str], t: Tables, s: Settings, path: str) -> dict[str, DataFrame]:
    """Compute each metric once into a table below ``path`` and return the stored results, for boards to read.

    Independent jobs, so a few run at a time.
    """
    spark, keys = SparkSession.active(), list(dict.fromkeys(keys))
    shared = Shared(metrics, keys, t, s)

    def write(key: str) -> None:
        shared.rows(key).write.mode("overwrite").parquet(f"{path}/{key}")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, shared.spread(keys)))
    return {key: spark.read.parquet(f"{path}/{key}") for key in keys}


def build(metrics: Mapping[str, Metric], t: Tables, s: Settings, path: str) -> dict[str, str]:
    """Compute all metrics one by one; a failing one is left empty and reported."""
    shared = Shared(metrics, metrics, t, s)
    return snapshots.write_each({key: (lambda key=key: shared.rows(key)) for key in metrics}, path)
