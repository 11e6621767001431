"""First-half board: payment promises, after-sales use, net revenue, activation and booking frequency.

Every metric takes the role tables and the settings and returns a DataFrame; nothing runs until it is written.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import dates, fixed
from kpiloom.functions.numbers import money, pct, rounded
from kpiloom.functions.text import classify, column, filled, recode, strip_prefix
from kpiloom.operators import cohort
from kpiloom.operators.aggregate import entity_counts
from kpiloom.operators.cumulative import cumulate, cumulative_distinct, cumulative_sum, first_seen, first_steps
from kpiloom.operators.joins import flag_join, skew_join
from kpiloom.plans.settings import Settings
from kpiloom.sources.tables import Tables, latest_reservations, sales_since


# Payment promises -----------------------------------------------------------------------------------------------------


def promise_status(t: Tables, s: Settings, deadline: Column) -> DataFrame:
    """Reservations with a payment promise whose deadline day satisfies ``deadline`` (a predicate on column ``day``).

    Side tables are reduced to one row per key with a multiplicity, so a reservation with many cancellations or sale
    lines is not a row per pair. A time-out is only known from the sale rows; a reservation with several sale statuses
    has several rows.
    """
    promised = (
        t.deferred.where((F.col("reason") == fixed.PROMISE_REASON) & F.col("deadline").isNotNull())
        .select(F.col("reservation_id").alias("oid"), F.to_date("deadline").alias("day"))
        .where(deadline)
        .groupBy("oid", "day").agg(F.count("*").alias("_n_promise"))
    )
    cancelled = t.cancellations.groupBy(F.col("reservation_id").alias("oid"), "type").agg(F.count("*").alias("_n_cancel"))
    reservations = (
        latest_reservations(t.reservations)
        .where(F.col("channel").startswith(s.channel_prefix))
        .select("id", "oid", "status", F.col("id").try_cast("bigint").alias("_tc"))
    )
    held = reservations.join(promised, "oid")
    # only the sales of the promised reservations are grouped
    sold = (
        sales_since(t.sales, s.promise_sales_from, s.channels)
        .select(F.col("transaction_code").alias("_tc"), "transaction_status", money("gb").alias("_v"))
        .join(held.select("_tc"), "_tc", "left_semi")
        .groupBy("_tc", "transaction_status")
        .agg(F.sum("_v").alias("_gb"))
    )
    joined = held.join(cancelled, "oid", "left").join(sold, "_tc", "left")
    timed_out = (F.col("transaction_status") == fixed.CANCELLED) & (F.col("type") == fixed.TIMEOUT_TYPE)
    return joined.select(
        F.col("id").alias("reservation_id"),
        F.when(timed_out, fixed.TIMEOUT_STATUS).otherwise(F.col("status")).alias("status"),
        "day",
        (F.col("_gb") * F.col("_n_promise") * F.coalesce(F.col("_n_cancel"), F.lit(1))).alias("gb"),
    )


def promise_base(t: Tables, s: Settings) -> DataFrame:
    """The promised reservations that the three promise metrics look at."""
    return promise_status(t, s, (F.col("day") <= F.lit(s.as_of)) | (F.col("day") >= F.lit(s.weeks_from)))


def promise_weeks(t: Tables, s: Settings) -> DataFrame:
    """``promise_base`` of the two weekly metrics, which ask for no value."""
    return promise_status(t, s, F.col("day") >= F.lit(s.weeks_from)).drop("gb")


def _promises(t: Tables, s: Settings, base: DataFrame | None, deadline: Column) -> DataFrame:
    rows = promise_status(t, s, deadline) if base is None else base.where(deadline)
    return rows.withColumns({"semana_inicio": dates.week_start("day"), "mes_deadline": dates.month_start("day")})


def kr21(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Promised reservations and their value by deadline month and status. ``base``: a stored ``promise_base``."""
    rows = _promises(t, s, base, F.col("day") <= F.lit(s.as_of))
    out = entity_counts(rows, ["mes_deadline", "status"], {"reservas": ("reservation_id", None)}, {"gb": F.col("gb")})
    return out.withColumn("gb", rounded("gb", 2))


def kr21_sem(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Time-out share per deadline week."""
    timed_out = F.col("status") == fixed.TIMEOUT_STATUS
    out = entity_counts(
        _promises(t, s, base, F.col("day") >= F.lit(s.weeks_from)), ["semana_inicio"],
        {"total_reservas": ("reservation_id", None), "reservas_timeout_client": ("reservation_id", timed_out)},
    )
    return out.withColumn("pct_timeout_client", pct("reservas_timeout_client", "total_reservas"))


def kr21_sem_cum(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Time-out share accumulated in the month, per week and month."""
    out = cumulative_distinct(
        _promises(t, s, base, F.col("day") >= F.lit(s.weeks_from)), "mes_deadline", "semana_inicio", "reservation_id",
        {"timeout": F.col("status") == fixed.TIMEOUT_STATUS},
    )
    return out.select(
        "semana_inicio", "mes_deadline", F.col("cumulative").alias("total_reservas_acum"),
        F.col("cumulative_timeout").alias("timeouts_acum"), pct("cumulative_timeout", "cumulative").alias("pct_timeout_acum"),
    )


# After-sales requests -------------------------------------------------------------------------------------------------


def _requests(t: Tables, s: Settings, months: tuple[str, ...]) -> DataFrame:
    return t.requests.where((F.col("creation_yearmonth") >= s.requests_from) & F.col("creation_yearmonth").isin(*months))


def _request_transactions(t: Tables, s: Settings) -> DataFrame:
    return t.transactions.where(
        F.col("reservation_year_month").isNotNull() & (F.col("line_of_business") == fixed.B2B)
        & F.col("channel").contains(s.channel_token)
    )


def kr22(t: Tables, s: Settings) -> DataFrame:
    """Requests per month by staff and others, and the agencies behind them."""
    requests = (
        _requests(t, s, s.request_months)
        .groupBy(
            "creation_yearmonth", strip_prefix("created_user", fixed.STAFF_PREFIX, 5).alias("user"), "transaction_code"
        )
        .agg(F.count("*").alias("_n"))
    )
    agencies = _request_transactions(t, s).groupBy("transaction_code", "agency_code").agg(F.count("*").alias("_m"))
    staff = t.payroll.select(strip_prefix("ad_username", fixed.STAFF_PREFIX, 5).alias("user"))
    joined = requests.join(agencies, "transaction_code").withColumn("n", F.col("_n") * F.col("_m"))
    flagged = flag_join(joined, staff, "user", "staff", split=True, probe=requests)
    out = entity_counts(
        flagged, ["creation_yearmonth"], {"cant_agencias_unicas": ("agency_code", None)},
        {
            "cant_staff": F.when(F.col("staff") == 1, F.col("n")).otherwise(0),
            "cant_no_staff": F.when(F.col("staff") == 0, F.col("n")).otherwise(0),
            "cant_total": F.col("n"),
        },
    )
    return out.select("cant_staff", "cant_no_staff", "cant_total", "cant_agencias_unicas", "creation_yearmonth")


def agency_requests(t: Tables, s: Settings, since: date | None = None, until: date | None = None) -> DataFrame:
    """Agencies with a request, by month and week; of the days ``since``..``until`` if given."""
    requests = _requests(t, s, s.request_week_months)
    if since is not None:
        requests = requests.where(F.to_date("creation_date").between(F.lit(since), F.lit(until)))
    requests = requests.select("transaction_code", "creation_date").distinct()
    agencies = _request_transactions(t, s).select("transaction_code", "agency_code").distinct()
    return requests.join(agencies, "transaction_code").select(
        dates.month_start("creation_date").alias("mes_inicio"), dates.week_start("creation_date").alias("semana_inicio"),
        "agency_code",
    )


def request_base(t: Tables, s: Settings) -> DataFrame:
    """The agencies with a request of each month and week, once."""
    return agency_requests(t, s).distinct()


def kr22_sem(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Agencies with requests per week. ``base``: a stored ``request_base``."""
    rows = agency_requests(t, s) if base is None else base
    return entity_counts(rows, ["semana_inicio"], {"cant_agencias_unicas": ("agency_code", None)})


def kr22_sem_cum(t: Tables, s: Settings, by: str = "step", base: DataFrame | None = None) -> DataFrame:
    """Agencies with requests accumulated in the month. A week in two months counts the agencies of both; with
    ``by="period_step"`` there is a row per week and month."""
    rows = agency_requests(t, s) if base is None else base
    return requests_so_far(first_seen(rows, "mes_inicio", "semana_inicio", "agency_code"), by)


def requests_so_far(seen: DataFrame, by: str = "step") -> DataFrame:
    out = cumulate(seen, "mes_inicio", "semana_inicio", "agency_code", by=by)
    keys = ["semana_inicio"] if by == "step" else ["semana_inicio", "mes_inicio"]
    return out.select(*keys, F.col("cumulative").alias("cant_agencias_acum_mes"))


# Net revenue ----------------------------------------------------------------------------------------------------------


def adjusted_revenue() -> Column:
    """Net revenue after the country factors; the first rule that holds decides."""
    net, affiliates = money("net_revenues_usd"), money("affiliates_usd")
    country, product = F.col("country_code"), F.col("product")
    brazil = country == "BR"

    def times(value: Column, factor: str) -> Column:
        return (value * F.lit(factor).cast("decimal(4,2)")).cast("decimal(28,8)")

    out = F.when(brazil & (F.col("parent_channel") == fixed.AFFILIATES) & (product != fixed.FLIGHTS), times(net - affiliates, fixed.FACTOR_BR))
    for code, factor in fixed.FACTOR_BY_COUNTRY.items():
        out = out.when(country == code, times(net, factor))
    return out.when(brazil & (product == fixed.FLIGHTS), times(net, fixed.FACTOR_BR)).otherwise(times(net, fixed.FACTOR_DEFAULT))


def revenue_country() -> Column:
    country = F.col("country_code")
    return classify(
        [
            (F.col("partner_id").isin(*fixed.OTHER_PARTNERS), fixed.OTHER_COUNTRY),
            *[(country == c, c) for c in fixed.REVENUE_COUNTRIES],
        ],
        fixed.OTHER_COUNTRY,
    )


def revenue_product(services: str = fixed.SERVICES) -> Column:
    kind = F.col("buy_type_code")
    return (
        F.when(kind.isin(*fixed.PACKAGE_BUY_TYPES), fixed.PACKAGES)
        .when(kind.isin(*fixed.SERVICE_BUY_TYPES), services)
        .otherwise(kind)
    )


def revenue_lines(t: Tables, s: Settings, since) -> DataFrame:
    """Sale lines with their adjusted net revenue. Side tables that are joined but never read are left out; their keys
    must be unique (``sources.tables.repeated_keys``)."""
    lines = t.sales.where(
        (F.col("gestion_date") >= F.lit(since)) & (F.col("partition_period") >= s.revenue_period_from)
        & F.col("lob_gestion").isin(*s.revenue_lines) & (F.col("parent_channel") == fixed.AFFILIATES)
    ).select(
        "product_id", "transaction_code", "partner_id", "country_code", "parent_channel", "product", "buy_type_code",
        "gestion_date",
    )
    # a product id may be a placeholder that many lines share
    profit = t.profit.where(
        (F.col("line_of_business") == fixed.B2B) & (F.col("date_reservation_year_month") >= s.revenue_period_from[:7])
    ).select("product_id", F.col("transaction_code").cast("string").alias("_tc"), "net_revenues_usd", "affiliates_usd")
    current = t.transactions.where(F.col("reservation_year_month") >= F.lit(s.revenue_from)).select(
        F.col("transaction_code").alias("_tc")
    )
    joined = skew_join(lines, profit, "product_id", "inner")
    return joined.join(current, "_tc").withColumn("net_revenue", adjusted_revenue())


def sheet_revenue(sheet: DataFrame, separator: str, source: str) -> DataFrame:
    """Monthly net revenue of a text sheet per product and country. A text that is no number or date fails the query."""
    rows = sheet.where(F.col("lob_canal") == fixed.SHEET_LINE).select(
        dates.sheet_year("fecha", separator).alias("year"), F.col("no_mes_proyectado").cast("int").alias("month"),
        recode("producto", fixed.SHEET_PRODUCTS).alias("producto"),
        recode("pais", fixed.SHEET_COUNTRIES, fixed.OTHER_COUNTRY).alias("pais"),
        F.col("net_revenue").cast("decimal(15,6)").alias("_v"),
    )
    return rows.groupBy("year", "month", "producto", "pais").agg(F.sum("_v").alias("net_revenue_target")).withColumn(
        "source", F.lit(source)
    )


def revenue_targets(t: Tables, sources=("FCST", "BDGT")) -> DataFrame:
    parts = {"FCST": lambda: sheet_revenue(t.forecast, "/", "FCST"), "BDGT": lambda: sheet_revenue(t.budget, "-", "BDGT")}
    out = None
    for source in sources:
        part = parts[source]()
        out = part if out is None else out.unionByName(part)
    return out


def revenue_base(t: Tables, s: Settings) -> DataFrame:
    """Net revenue per day, country and kind of product, of all days that the three revenue metrics look at."""
    lines = revenue_lines(t, s, min(s.revenue_from, s.weeks_from))
    return lines.groupBy("gestion_date", revenue_country().alias("pais"), "buy_type_code").agg(F.sum("net_revenue").alias("net_revenue"))


def revenue_weeks(t: Tables, s: Settings) -> DataFrame:
    """Net revenue per day, which is enough for the two weekly metrics."""
    return revenue_lines(t, s, s.weeks_from).groupBy("gestion_date").agg(F.sum("net_revenue").alias("net_revenue"))


def _revenue(t: Tables, s: Settings, base: DataFrame | None, since: date) -> DataFrame:
    if base is None:
        return revenue_lines(t, s, since).withColumn("pais", revenue_country())
    return base.where(F.col("gestion_date") >= F.lit(since))


def kr31(
    t: Tables, s: Settings, sources=("FCST", "BDGT"), align_services: bool = False, base: DataFrame | None = None
) -> DataFrame:
    """Actual against planned net revenue per month. ``base``: a stored ``revenue_base``.

    With both sources an actual that has a forecast and a budget row counts with each of them; pick one source to count
    it once. ``align_services`` gives the services of the actuals the label of the sheets.
    """
    services = fixed.SHEET_PRODUCTS["Dest. Serv."] if align_services else fixed.SERVICES
    # the years are chosen on each side: a filter above the full join would reach neither
    actual = (
        _revenue(t, s, base, s.revenue_from)
        .where(F.year("gestion_date").isin(*s.revenue_years))
        .groupBy(
            F.year("gestion_date").alias("year"), F.month("gestion_date").alias("month"),
            "pais", revenue_product(services).alias("producto"),
        )
        .agg(F.sum("net_revenue").alias("net_revenue_real"))
    )
    targets = revenue_targets(t, sources).where(F.col("year").isin(*s.revenue_years))
    both = targets.join(actual, ["year", "month", "pais", "producto"], "full_outer")
    period = F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0"))
    return (
        both.groupBy(period.alias("periodo"))
        .agg(
            F.sum(F.round("net_revenue_real", 2)).cast("double").alias("net_rev_real"),
            F.sum(F.round("net_revenue_target", 2)).cast("double").alias("net_rev_target"),
        )
    )


def kr31_sem(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Adjusted net revenue per week."""
    weekly = _revenue(t, s, base, s.weeks_from).groupBy(dates.week_start("gestion_date").alias("semana_inicio"))
    return weekly.agg(rounded(F.sum("net_revenue"), 2).alias("net_revenue_real"))


def kr31_sem_cum(t: Tables, s: Settings, by: str = "step", base: DataFrame | None = None) -> DataFrame:
    """Adjusted net revenue accumulated in the month; a week in two months adds up both."""
    lines = _revenue(t, s, base, s.weeks_from).select(
        dates.month_start("gestion_date").alias("mes_inicio"), dates.week_start("gestion_date").alias("semana_inicio"),
        "net_revenue",
    )
    out = cumulative_sum(lines, "mes_inicio", "semana_inicio", "net_revenue", by)
    keys = ["semana_inicio"] if by == "step" else ["semana_inicio", "mes_inicio"]
    return out.select(*keys, rounded("cumulative", 2).alias("net_revenue_acum_mes"))


# Activation -----------------------------------------------------------------------------------------------------------


def quotes_between(t: Tables, s: Settings, since, until) -> DataFrame:
    """Quotations of known agencies: day and upper-case agency."""
    day = F.to_date("created_at")
    return t.quotations.where(
        day.between(F.lit(since), F.lit(until)) & F.col("channel_code").isin(*s.channels) & filled("agency_code")
    ).select(day.alias("d"), F.upper("agency_code").alias("agency"))


def confirmed_between(t: Tables, s: Settings, since, until) -> DataFrame:
    sold = sales_since(t.sales, since.strftime("%Y-%m"), s.channels).where(
        F.col("creation_date").between(F.lit(since), F.lit(until)) & (F.col("transaction_status") == fixed.CONFIRMED)
        & F.col("agency_code").isNotNull()
    )
    return sold.select(F.col("creation_date").alias("d"), F.upper("agency_code").alias("agency"))


def kr32(t: Tables, s: Settings) -> DataFrame:
    """Share of the quoting agencies that sold in the same month."""
    quotes = quotes_between(t, s, s.activation_from, s.as_of).withColumn("mes", dates.month_start("d"))
    sold = confirmed_between(t, s, s.activation_from, s.as_of).withColumn("mes", dates.month_start("d"))
    return cohort.activation(quotes, sold, "mes", "agency").select(
        "mes", F.col("quoting").alias("agencias_cotizadoras"), F.col("converted").alias("agencias_cotizaron_y_vendieron"),
        F.col("quotes").alias("cotizaciones_realizadas"), F.col("pct").alias("pct_activacion_comercial"),
    )


def weekly_sides(t: Tables, s: Settings, since: date | None = None, until: date | None = None) -> tuple[DataFrame, DataFrame]:
    """Quotes and sales by month and week, of the reported weeks or of the days ``since``..``until`` among them."""
    keys = {"mes_inicio": dates.month_start("d"), "semana_inicio": dates.week_start("d")}
    first, last = max(since or s.weeks_from, s.weeks_from), min(until or s.weeks_to, s.weeks_to)
    return quotes_between(t, s, first, last).withColumns(keys), confirmed_between(t, s, first, last).withColumns(keys)


def activation_base(t: Tables, s: Settings) -> DataFrame:
    """Quotes (_q) and sales (_s) of each agency per month and week."""
    return cohort.paired(*weekly_sides(t, s), ["mes_inicio", "semana_inicio", "agency"], "_q", "_s")


def kr32_sem(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Share of the quoting agencies that sold in the same week. ``base``: a stored ``activation_base``."""
    if base is None:
        shares = cohort.activation(*weekly_sides(t, s), "semana_inicio", "agency")
    else:  # a week in two months has a row for each
        weekly = base.groupBy("semana_inicio", "agency").agg(F.sum("_q").alias("_q"), F.sum("_s").alias("_s"))
        shares = cohort.activation_shares(weekly, "semana_inicio", "agency")
    return shares.select(
        "semana_inicio", F.col("quoting").alias("agencias_cotizadoras"),
        F.col("converted").alias("agencias_cotizaron_y_vendieron"), F.col("pct").alias("pct_activacion_comercial"),
    )


def kr32_sem_cum(t: Tables, s: Settings, by: str = "step", base: DataFrame | None = None) -> DataFrame:
    """Agencies that quoted and bought up to each week of the month."""
    if base is None:
        both = cohort.activation_rows(*weekly_sides(t, s), "mes_inicio", "semana_inicio", "agency")
    else:
        steps = [F.when(F.col(n) > 0, F.col("semana_inicio")).alias(n) for n in ("_q", "_s")]
        both = base.select("mes_inicio", "agency", *steps)
    return activation_so_far(first_steps(both, "mes_inicio", "_q", "agency", {"sold": F.col("_s")}), by)


def activation_so_far(seen: DataFrame, by: str = "step") -> DataFrame:
    out = cohort.activation_counts(seen, "mes_inicio", "semana_inicio", "agency", by)
    keys = ["semana_inicio"] if by == "step" else ["semana_inicio", "mes_inicio"]
    return out.select(
        *keys, F.col("cumulative").alias("agencias_cotizadoras_acum"),
        F.col("cumulative_sold").alias("agencias_compraron_acum"), F.col("pct").alias("pct_activacion_acum"),
    )


# Booking frequency ----------------------------------------------------------------------------------------------------


def _uplift_from(s: Settings) -> date:
    """The first day of the first month that counts."""
    return max(date(s.uplift_month_from // 100, s.uplift_month_from % 100, 1), s.bookings_after + timedelta(days=1))


def booking_base(
    t: Tables, s: Settings, since: date | None = None, days: bool = True, grain: Column | str = "creation_date"
) -> DataFrame:
    """Distinct bookings (day, partner_id, transaction_code) of reservations that are not about to be cancelled.

    Bookings are made distinct first; only their number is asked, so the reservation is a semi join. A reservation
    without status does not pass, as its status is unknown. With ``days`` every day that has any sale, of whatever
    channel, has a row without booking, so weeks with sales are known without another read. ``grain``: the day, or the first
    day of its period.
    """
    since = since or min(_uplift_from(s), s.weeks_from)
    sales = sales_since(t.sales, since.strftime("%Y-%m"), None if days else s.wide_channels)
    sales = sales.where(F.col("creation_date") >= F.lit(since))
    ours = F.col("channel").isin(*s.wide_channels)
    bookings = sales.select(
        column(grain).alias("day"), *[F.when(ours, F.col(c)).alias(c) for c in ("partner_id", "transaction_code")]
    ).distinct()
    live = latest_reservations(t.reservations).where(F.col("status") != fixed.TO_CANCEL).select(
        F.col("id").try_cast("bigint").alias("transaction_code")
    )
    if not days:
        return bookings.join(live, "transaction_code", "left_semi").select("day", "partner_id", "transaction_code")
    known = flag_join(bookings, live, "transaction_code", "_live")
    booked = F.col("_live") == 1
    return known.select("day", *[F.when(booked, F.col(c)).alias(c) for c in ("partner_id", "transaction_code")]).distinct()


def channel_bookings(t: Tables, s: Settings) -> DataFrame:
    """``booking_base`` without the days that only have sales of other channels."""
    return booking_base(t, s, days=False)


def bookings_per(base: DataFrame, since: date, **grain: Column) -> DataFrame:
    """Bookings per partner and grain (named columns of ``day``)."""
    own = base.where((F.col("day") >= F.lit(since)) & F.col("transaction_code").isNotNull())
    distinct = own.select(*[c.alias(n) for n, c in grain.items()], "partner_id", "transaction_code").distinct()
    return distinct.groupBy(*grain, "partner_id").agg(F.count("transaction_code").alias("reservas"))


def _monthly(base: DataFrame, s: Settings) -> DataFrame:
    return bookings_per(base, _uplift_from(s), mes=dates.yyyymm("day"))


def kr33(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Agencies with 1-3 bookings in a month that made two or more additional ones in the next. ``base``: a stored ``booking_base``."""
    if base is None:  # alone, bookings are made distinct by month at once
        by_month = booking_base(t, s, _uplift_from(s), days=False, grain=dates.month_start("creation_date"))
        monthly = by_month.groupBy(dates.yyyymm("day").alias("mes"), "partner_id").agg(F.count("transaction_code").alias("reservas"))
    else:
        monthly = _monthly(base, s)
    return cohort.uplift(monthly, s.uplift_target).where(F.col("mes_previo") >= s.uplift_month_from)


def kr33_sem(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Monthly uplift shown on the weeks of the evaluated month that have sales; a week in two months has two rows."""
    base = booking_base(t, s) if base is None else base
    weeks = base.where(F.col("day") >= F.lit(s.weeks_from)).select(
        dates.week_start("day").alias("semana_inicio"), dates.yyyymm("day").alias("mes_evaluacion")
    ).distinct()
    return weeks.join(kr33(t, s, base).select("mes_evaluacion", "pct_aumento"), "mes_evaluacion").select("semana_inicio", "pct_aumento")


def kr33_sem_cum(t: Tables, s: Settings, match_month: bool = False, base: DataFrame | None = None) -> DataFrame:
    """Uplift with the bookings accumulated to each week of the evaluated month."""
    base = channel_bookings(t, s) if base is None else base
    weekly = bookings_per(base, s.weeks_from, semana_inicio=dates.week_start("day"), mes=dates.yyyymm("day"))
    return cohort.uplift_cumulative(_monthly(base, s), weekly, match_month=match_month)


#: What several metrics are derived from; a board stores it once and hands it to each of them.
BASES = {
    "kr21": promise_base, "kr21_sem": promise_base, "kr21_sem_cum": promise_base,
    "kr33": booking_base, "kr33_sem": booking_base, "kr33_sem_cum": booking_base,
    "kr22_sem": request_base, "kr22_sem_cum": request_base,
    "kr31": revenue_base, "kr31_sem": revenue_base, "kr31_sem_cum": revenue_base,
    "kr32_sem": activation_base, "kr32_sem_cum": activation_base,
}
#: A smaller base of some of them, for runs without the others.
NARROW = {
    "kr21_sem": promise_weeks, "kr21_sem_cum": promise_weeks, "kr31_sem": revenue_weeks, "kr31_sem_cum": revenue_weeks,
    "kr33_sem_cum": channel_bookings,
}
#: Metrics that read their base several times, so it is stored for one alone as well.
REPEATED = ("kr33_sem_cum",)
