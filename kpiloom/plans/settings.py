"""Parameters of the metric families. Dates default to the fixed reporting windows; ``as_of`` replaces "today"."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from kpiloom.functions import fixed


@dataclass(frozen=True)
class Settings:
    as_of: date
    # Channel and line codes of the account.
    channels: tuple[str, ...]
    wide_channels: tuple[str, ...] = ()
    channel_prefix: str = ""
    channel_token: str = ""
    revenue_lines: tuple[str, ...] = ()

    # First-half board.
    promise_sales_from: str = "2024-01"
    weeks_from: date = date(2026, 4, 1)
    weeks_to: date = date(2026, 9, 30)
    requests_from: str = "2025-01"
    request_months: tuple[str, ...] = (
        "2026-03", "2026-04", "2026-05", "2026-06", "2026-07", "2026-08", "2026-09", "2026-10", "2026-11", "2026-12",
        "2027-01", "2027-02", "2027-03",
    )
    request_week_months: tuple[str, ...] = fixed.FIRST_HALF_MONTHS
    revenue_from: date = date(2025, 1, 1)
    # A full date text here ("2025-01-01") drops the first month, as "2025-01" sorts before it.
    revenue_period_from: str = "2025-01"
    revenue_years: tuple[int, ...] = (2025, 2026)
    activation_from: date = date(2026, 1, 1)
    bookings_after: date = date(2023, 1, 1)
    uplift_month_from: int = 202501
    uplift_target: float = fixed.UPLIFT_TARGET

    # Second-half board.
    own_methods_from: str = "2026-10"
    own_method_targets: tuple = fixed.OWN_METHOD_TARGETS
    quoting_from: date = date(2026, 10, 1)
    quoting_to: date = date(2027, 3, 31)
    quoting_targets: tuple = fixed.QUOTING_TARGETS
    calendar: tuple = fixed.COMMERCIAL_CALENDAR
    orders_from: date = date(2026, 10, 5)
    orders_month_from: date = date(2026, 10, 1)
    frequent_targets: tuple = fixed.FREQUENT_TARGETS

    # Initiatives.
    link_launches: Mapping[str, date] = field(default_factory=lambda: dict(fixed.LINK_LAUNCHES))
    wallet_launches: Mapping[str, date] = field(default_factory=lambda: dict(fixed.WALLET_LAUNCHES))
    deferred_launch: date = fixed.DEFERRED_LAUNCH
    deferred_country: str = fixed.DEFERRED_COUNTRY
    package_countries: tuple[str, ...] = fixed.PACKAGE_COUNTRIES
    grid_launch: date = fixed.GRID_LAUNCH
    grid_countries: tuple[str, ...] = fixed.GRID_COUNTRIES
    promise_launch: date = fixed.PROMISE_LAUNCH
    promise_history_from: date = fixed.PROMISE_HISTORY
    wallet_label: str = "Wallet"

    # Filter usability.
    anchor: date = fixed.WEEK_ANCHOR
