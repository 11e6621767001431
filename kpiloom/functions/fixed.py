"""Codes, labels, factors, targets and dates that decide the results.

Sales channels and line-of-business codes belong to the caller's account and are passed as parameters
(see ``kpiloom.plans.settings``).
"""

from __future__ import annotations

from datetime import date

# Statuses and codes found in the input tables.
CONFIRMED = "Confirmado"
ACTIVE = "Activo"
CANCELLED = "Cancelado"
TIMEOUT_TYPE = "TIMEOUT_CLIENT"
TIMEOUT_STATUS = "Time_out_client"
TO_CANCEL = "TO_CANCEL"
PROMISE_REASON = "PROMISE-B2B"
B2B = "B2B"
AFFILIATES = "Agencias afiliadas"
SHEET_LINE = "B2B-MIN"
STAFF_PREFIX = "ext."
PARTNER_PREFIX = "WLAG"
WALLET_CHANNEL = "DWALLET"

# Products of the text sheets.
SHEET_PRODUCTS = {
    "Cars": "Autos",
    "Cruises": "Cruceros",
    "Dest. Serv.": "Dest. Serv.",
    "Flights": "Vuelos",
    "Hotels": "Hoteles",
    "Insurance": "Asistencia al viajero",
    "Packages General": "Paquetes",
    "Vacation Rentals": "Alquileres",
}

# Countries of the text sheets; any other is "O".
SHEET_COUNTRIES = {
    "Argentina": "AR",
    "Brasil": "BR",
    "Chile": "CL",
    "Colombia": "CO",
    "Ecuador": "EC",
    "Mexico": "MX",
    "Peru": "PE",
    "Uruguay": "UY",
}
REVENUE_COUNTRIES = ("MX", "BR", "CO", "AR", "EC", "PE", "CL", "UY")
OTHER_COUNTRY = "O"

# Partners reported under "O" whatever their country.
OTHER_PARTNERS = (
    "AP12142", "AP12961", "AP12767", "AP12539", "AP12792", "AP12149", "AP12148", "AG00015606", "AP13029", "AP13030",
    "AP13091", "AP13104", "AG00015611",
)

# Buy types grouped for the revenue report. The actuals carry "Dest. Serv" and the sheets "Dest. Serv.".
PACKAGE_BUY_TYPES = ("Bundles", "Carrito")
SERVICE_BUY_TYPES = ("Actividades", "Traslados")
PACKAGES = "Paquetes"
SERVICES = "Dest. Serv"

# Net revenue factors by country.
FACTOR_BY_COUNTRY = {"MX": "0.85", "CO": "0.84", "CL": "0.92", "US": "0.80", "PA": "0.80"}
FACTOR_BR = "0.92"
FACTOR_DEFAULT = "0.97"
FLIGHTS = "Vuelos"
HOTELS = "Hoteles"

# Second-half targets of the value sold with own payment methods.
OWN_METHODS = ("WALLET", "CURRENT_ACCOUNT", "AGENCY_ACCOUNT")
OWN_METHOD_TARGETS = (
    ("2026-10", 3282530.45),
    ("2026-11", 3883044.26),
    ("2026-12", 4461921.25),
    ("2027-01", 5729302.40),
    ("2027-02", 6214359.64),
    ("2027-03", 7760774.05),
    ("2027-04", 9942669.48),
)

# Second-half targets of agencies that quote: month, weeks, target.
QUOTING_TARGETS = (
    (date(2026, 10, 1), 4, 7500),
    (date(2026, 11, 1), 4, 7718),
    (date(2026, 12, 1), 5, 7601),
    (date(2027, 1, 1), 4, 7910),
    (date(2027, 2, 1), 4, 7818),
    (date(2027, 3, 1), 4, 8100),
)

# Commercial calendar: month, first day, last day, weeks.
COMMERCIAL_CALENDAR = (
    ("2026-10", date(2026, 10, 5), date(2026, 11, 1), 4),
    ("2026-11", date(2026, 11, 2), date(2026, 11, 29), 4),
    ("2026-12", date(2026, 11, 30), date(2027, 1, 3), 5),
    ("2027-01", date(2027, 1, 4), date(2027, 1, 31), 4),
    ("2027-02", date(2027, 2, 1), date(2027, 2, 28), 4),
    ("2027-03", date(2027, 3, 1), date(2027, 3, 28), 4),
)
# Second-half targets of frequent buyers: month, weeks, target.
FREQUENT_TARGETS = (
    ("2026-10", 4, 3396),
    ("2026-11", 4, 3584),
    ("2026-12", 5, 3483),
    ("2027-01", 4, 3749),
    ("2027-02", 4, 3670),
    ("2027-03", 4, 3913),
)
FREQUENT_WEEKS = 3
CLOSED_STATE, RUNNING_STATE, PENDING_STATE = "CIERRE", "EN_CURSO", "PENDIENTE"

# Share of agencies with 1-3 bookings that should add two or more, in percent.
UPLIFT_TARGET = 25.0

# Staged rollouts: first day by country.
LINK_LAUNCHES = {
    "MX": date(2026, 9, 29),
    "AR": date(2026, 10, 13),
    "CL": date(2026, 10, 13),
    "BR": date(2026, 10, 19),
    "CO": date(2026, 10, 19),
    "PE": date(2026, 10, 19),
    "US": date(2026, 11, 11),
}
WALLET_LAUNCHES = {
    "AR": date(2026, 10, 26),
    "CL": date(2026, 10, 26),
    "CO": date(2026, 10, 26),
    "MX": date(2026, 10, 26),
    "BR": date(2026, 10, 29),
    "PE": date(2026, 10, 29),
}
WALLET_PRE_DAYS = 60
DEFERRED_LAUNCH = date(2026, 10, 19)
DEFERRED_COUNTRY = "AR"
PACKAGE_COUNTRIES = ("AR", "BR", "MX", "CL", "CO", "PE")
PACKAGE_FLOW = "FLIGHT_HOTEL"
GRID_LAUNCH = date(2026, 11, 12)
GRID_COUNTRIES = ("AR", "BR", "CL", "CO", "MX", "PE")
GRID_PRE_WEEKS = 10
GRID_SHOW = "calendarPricesMatrix"
GRID_TAB = "calendarPricesMatrixTab"
GRID_CHEAPEST = "calendarPricesMatrixCheapestTab"
PROMISE_LAUNCH = date(2026, 10, 13)
PROMISE_HISTORY = date(2024, 1, 1)

# Payment mix: the first text found decides. REMOTE with a future penalty comes before these.
LINK_NEW, LINK_OLD = "Link de pago (nuevo)", "Link pre-booking (previo)"
MIX_LABELS = (
    ("AGENCY_ACCOUNT", "Cuenta corriente"),
    ("WALLET", "Wallet"),
    ("DEFERRED_PAYMENT", "Pago diferido"),
    ("DEFERRED", "Gestor de pagos"),
    ("CASH", "Cash"),
    ("DEBIT", "Débito"),
    ("CREDIT", "Tarjeta crédito"),
)
OTHERS = "Otros"
MIX_PRE_BLOCKS = 4

# Product groups of the payment-promise study.
PROMISE_GROUPS = {
    "Hoteles": "HO",
    "Alquileres": "AL",
    "Autos": "AU",
    "Traslados": "TR",
    "Asistencia al viajero": "AS",
    "Excursiones": "AC",
    "Espectáculos": "AC",
    "Vuelos": "VU",
    "Disney": "PQ",
    "Universal": "PQ",
    "SeaWorld": "PQ",
    "Busch Gardens": "PQ",
    "Seguros de Autos": "SA",
}
OTHER_GROUP = "OT"
ALL_GROUPS = "TT"
NEW_GROUPS = ("AU", "TR", "AS", "AC")
KNOWN_GROUPS = ("HO", "AL")
STATUS_CODES = {"Confirmado": "C", "Activo": "A", "Cancelado": "X"}

# Counterfactual: weeks before the launch that are fitted, and the t(0.90) quantile by degrees of freedom.
FIT_WINDOWS = (8, 12, 16)
MAIN_WINDOW = 12
T_QUANTILES = {6: 1.440, 7: 1.415, 8: 1.397, 9: 1.383, 10: 1.372, 11: 1.363, 12: 1.356, 13: 1.350, 14: 1.345}
T_DEFAULT = 1.372

# Filter usability.
WEEK_ANCHOR = date(2026, 8, 28)
WEEK_MARGIN_DAYS = 1
WEEKS_KEPT = 26
USAGE_COUNTRIES = ("BR", "MX", "CO", "AR", "CL", "PE")
OTHER_USAGE_COUNTRY = "OT"
# Traffic product -> (board product, source of its filter clicks).
USAGE_PRODUCTS = {
    "HOTELS": ("Hoteles", "map_a"),
    "VACATION RENTALS": ("Hoteles", "map_a"),
    "FLIGHTS": ("Vuelos", "array"),
    "CARS": ("Autos", "map_b"),
    "ACTIVITIES": ("Actividades", "label"),
    "COMBINED PRODUCT": ("Paquetes", "map_a"),
}
NOT_FILTER_LABELS = ("sorting", "ai-search")

# Scorecards: metric, squad, weight, lower is better, six monthly targets (None: the target comes from the rows).
FIRST_HALF_MONTHS = ("2026-04", "2026-05", "2026-06", "2026-07", "2026-08", "2026-09")
FIRST_HALF_BOARD = (
    ("kr21", "es", 7, True, (22, 20, 18.25, 16.85, 15.75, 15)),
    ("kr22", "es", 13, False, (4500, 4500, 5025, 5445, 5775, 6000)),
    ("kr31", "ce", 16, False, (3622885, 4063503, 3888578, 3830895, 3717243, 3908286)),
    ("kr32", "ce", 7, False, (70, 70, 73, 74, 75, 77)),
    ("kr33", "ce", 7, False, (25, 25, 25, 25, 25, 25)),
)
SECOND_HALF_MONTHS = ("2026-10", "2026-11", "2026-12", "2027-01", "2027-02", "2027-03")
SECOND_HALF_BOARD = (
    ("kr11", "es", 1, False, (3282530.45, 3883044.26, 4461921.25, 5729302.40, 6214359.64, 7760774.05)),
    ("kr12", "es", 0, True, (3.64, 3.6, 3.98, 3.72, 3.93, 3.49)),
    ("kr21", "ce", 1, False, (7500, 7718, 7601, 7910, 7818, 8100)),
    ("kr22", "ce", 1, False, (3396, 3584, 3483, 3749, 3670, 3913)),
)
FLOOR, CAP, GOOD, NEAR = 70.0, 130.0, 100.0, 80.0
ACTIVATION_REFERENCE = 70.0
MONITOR_UPLIFT_TARGET = 35.0
