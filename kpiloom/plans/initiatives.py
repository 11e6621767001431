"""Impact of initiatives: payment link, wallet combinations, deferred payment, price grid and payment promise."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import dates, fixed
from kpiloom.functions.numbers import money, rounded
from kpiloom.functions.text import classify, exclude_test, recode
from kpiloom.operators import calendar, funnel, rollout
from kpiloom.operators.aggregate import entity_counts, keep_total_rows, member_list, top_k
from kpiloom.operators.joins import flag_join, skew_join
from kpiloom.plans.settings import Settings
from kpiloom.sources.tables import Tables, latest_reservations, sales_since

TOTAL, SCOPE_TOTAL = "ALL", "TOT"


def _round_sums(df: DataFrame, *names: str, digits: int = 0) -> DataFrame:
    return df.withColumns({n: rounded(n, digits) for n in names})


def channel_sales(t: Tables, s: Settings, since: date) -> DataFrame:
    """Sale lines of the channels from a day on, test agencies left out."""
    sales = sales_since(t.sales, since.strftime("%Y-%m"), s.channels).where(F.col("creation_date") >= F.lit(since))
    return exclude_test(sales, "agency_name")


def with_product(sales: DataFrame, t: Tables, *columns: str, probe: DataFrame | None = None) -> DataFrame:
    """Attributes of the booked product; lines without one keep NULLs."""
    products = t.products.select(F.col("transaction_id").alias("origin_product_id"), *columns)
    return skew_join(sales, products, "origin_product_id", "left", probe)


# Payment link in non-refundable hotels --------------------------------------------------------------------------------


def hotel_sales(t: Tables, s: Settings, since: date) -> DataFrame:
    """Hotel lines of the launched countries with the payment data: d, c, p, an, r, st, gb, rf, pm, pen, fut, ld."""
    sales = channel_sales(t, s, since).where(
        (F.col("product") == fixed.HOTELS) & F.col("country_code").isin(*s.link_launches)
    ).select(
        "origin_product_id", "creation_date", "country_code", "partner_id", "agency_name", "transaction_code",
        "transaction_status", "gb",
    )
    joined = with_product(sales, t, "refundable", "payment_methods", "penalty_start_date")
    base = joined.select(
        F.col("creation_date").alias("d"), F.col("country_code").alias("c"), F.col("partner_id").alias("p"),
        F.col("agency_name").alias("an"), F.col("transaction_code").alias("r"), F.col("transaction_status").alias("st"),
        money("gb").alias("gb"), F.col("refundable").alias("rf"), F.col("payment_methods").alias("pm"),
        F.coalesce(F.col("penalty_start_date") >= F.col("creation_date"), F.lit(False)).alias("fut"),
    )
    return rollout.with_launch(base, s.link_launches)


def _link_base(t: Tables, s: Settings) -> DataFrame:
    return hotel_sales(t, s, min(s.link_launches.values()))


def _new_link() -> Column:
    return F.coalesce((~F.col("rf")) & F.col("pm").contains("REMOTE") & F.col("fut"), F.lit(False))


def fare_class() -> Column:
    """L new link, N other non-refundable, R refundable, X unknown."""
    return classify(
        [(_new_link() & (F.col("d") >= F.col("ld")), "L"), (~F.col("rf"), "N"), (F.col("rf"), "R")], "X"
    )


def ldp_daily(t: Tables, s: Settings) -> DataFrame:
    """Per day and country: value by fare class, in scope, bookings with the link, non-refundable value in scope."""
    base = _link_base(t, s).where(F.col("st") == fixed.CONFIRMED).withColumn("cls", fare_class())
    scope = F.col("d") >= F.col("ld")

    def value(predicate: Column) -> Column:
        return F.when(predicate, F.col("gb"))

    cls = F.col("cls")
    sums = {
        "ref": value(cls == "R"), "non": value(cls == "N"), "link": value(cls == "L"), "sd": value(cls == "X"),
        "scope": value(scope), "scope_nr": value(scope & ~F.col("rf")),
    }
    out = _round_sums(entity_counts(base, ["d", "c"], {"nl": ("r", cls == "L")}, sums), *sums)
    return out.select(dates.iso_text("d").alias("d"), "c", "ref", "non", "link", "sd", "scope", "nl", "scope_nr")


def ldp_country(t: Tables, s: Settings) -> DataFrame:
    """Per country since its launch: link bookings, value, agencies, cancellations and repeating agencies.

    ALL sums up the link rows and counts its agencies across countries; TOT is the whole hotel sale in scope.
    """
    # rows without the link belong to the scope only
    rows = _link_base(t, s).where(F.col("d") >= F.col("ld")).withColumn("c", F.when(_new_link(), F.col("c")).otherwise(SCOPE_TOTAL))
    confirmed, cancelled = F.col("st") == fixed.CONFIRMED, F.col("st") == fixed.CANCELLED
    out = entity_counts(
        rows, ["c"], {"nl": ("r", confirmed), "nc": ("r", cancelled), "ag": ("p", confirmed)},
        {"gl": F.when(confirmed, F.col("gb")), "gc": F.when(cancelled, F.col("gb"))}, {"ld": F.col("ld")},
        {"rep": ("p", confirmed, 2)}, ("c", {TOTAL: F.col("c") != SCOPE_TOTAL, SCOPE_TOTAL: None}),
    )
    own = F.when(~F.col("c").isin(TOTAL, SCOPE_TOTAL), F.col("ld"))
    out = out.withColumns({"ld": own, "rep": F.when(F.col("c") == SCOPE_TOTAL, F.lit(0)).otherwise(F.col("rep"))})
    out = keep_total_rows(out, "c", [TOTAL, SCOPE_TOTAL], ["nl", "ag", "nc", "rep"])
    out = _round_sums(out, "gl", "gc")
    return out.select("c", F.coalesce(dates.iso_text("ld"), F.lit("")).alias("ld"), "nl", "gl", "ag", "nc", "gc", "rep")


def ldp_totals(t: Tables, s: Settings) -> DataFrame:
    """Non-refundable confirmed sale since each launch, per country and in all."""
    rows = _link_base(t, s).where((F.col("d") >= F.col("ld")) & (F.col("st") == fixed.CONFIRMED) & ~F.col("rf"))
    out = entity_counts(
        rows, ["c"], {"nt": ("r", None), "agt": ("p", None)}, {"gt": F.col("gb")}, totals=("c", {TOTAL: None})
    )
    out = keep_total_rows(out, "c", [TOTAL], ["nt", "agt"])
    return _round_sums(out, "gt").select("c", "gt", "nt", "agt")


def ldp_top(t: Tables, s: Settings, k: int = 10) -> DataFrame:
    """Agencies with the largest value paid by the new link; the partner id decides ties."""
    rows = _link_base(t, s).where((F.col("d") >= F.col("ld")) & (F.col("st") == fixed.CONFIRMED) & _new_link())
    out = entity_counts(rows, ["p"], {"n": ("r", None)}, {"g": F.col("gb")}, {"an": F.col("an"), "c": F.col("c")})
    return top_k(_round_sums(out, "g"), "g", k, "p").select("p", "an", "c", "n", "g")


def mix_class(s: Settings) -> Column:
    """Payment method by the first text found; REMOTE comes first, split by the penalty date."""
    pm = F.col("payment_methods")
    remote = pm.contains("REMOTE")
    labels = [(text, s.wallet_label if text == "WALLET" else label) for text, label in fixed.MIX_LABELS]
    return classify(
        [
            (remote & (F.col("penalty_start_date") >= F.col("creation_date")), fixed.LINK_NEW),
            (remote, fixed.LINK_OLD),
            *[(pm.contains(text), label) for text, label in labels],
        ],
        fixed.OTHERS,
    )


def _confirmed_hotels(t: Tables, s: Settings, since: date) -> DataFrame:
    sales = channel_sales(t, s, since).where(
        (F.col("product") == fixed.HOTELS) & F.col("country_code").isin(*s.link_launches)
        & (F.col("transaction_status") == fixed.CONFIRMED)
    ).select("origin_product_id", "creation_date", "country_code", "transaction_code", money("gb").alias("gb"))
    return with_product(sales, t, "refundable", "payment_methods", "penalty_start_date")


def ldp_mix(t: Tables, s: Settings) -> DataFrame:
    """Daily payment mix of the non-refundable sale, from four weeks before the first launch."""
    since = min(s.link_launches.values()) - timedelta(days=7 * fixed.MIX_PRE_BLOCKS)
    rows = _confirmed_hotels(t, s, since).where(~F.col("refundable")).select(
        dates.iso_text("creation_date").alias("d"), F.col("country_code").alias("c"), mix_class(s).alias("g"),
        "transaction_code", "gb",
    )
    return _round_sums(entity_counts(rows, ["d", "c", "g"], {"n": ("transaction_code", None)}, {"gb": F.col("gb")}), "gb")


def cf_daily(t: Tables, s: Settings) -> DataFrame:
    """Daily non-refundable and total hotel value per country, from the longest fit window before the first launch."""
    since = min(s.link_launches.values()) - timedelta(days=7 * max(fixed.FIT_WINDOWS))
    rows = _confirmed_hotels(t, s, since).groupBy(dates.iso_text("creation_date").alias("d"), F.col("country_code").alias("c"))
    return rows.agg(
        rounded(F.sum(F.when(~F.col("refundable"), F.col("gb")))).alias("gl"), rounded(F.sum("gb")).alias("gt")
    )


# Wallet combined with other methods -----------------------------------------------------------------------------------


def wallet_methods(t: Tables, s: Settings, since: date, again_since: date) -> DataFrame:
    """Transactions collected with two or more methods, the wallet among them, and the others as sorted text.

    ``partner_before`` looks at the schedules from ``since`` on, ``partner`` only at those from ``again_since`` on; each is
    NULL where it finds no such combination. The number of methods per booking is that of the payment channels.
    """
    schedules = t.schedules.where(
        (F.col("status") == "CLOSED") & (F.col("created_at") >= F.lit(since).cast("timestamp"))
    ).select(
        F.col("id").alias("payment_schedule_id"), "transaction_id",
        (F.col("created_at") >= F.lit(again_since).cast("timestamp")).alias("_late"),
    )
    intentions = t.intentions.where(F.col("status") == "COLLECTED").select(
        "payment_schedule_id", F.col("id").alias("payment_intention_id")
    )
    scheduled = t.scheduled_collections.select("payment_intention_id", F.col("collectionId").alias("cobra_id"))
    live = latest_reservations(t.reservations).where(F.col("channel").isin(*s.channels)).select(
        F.col("oid").alias("reservation_id")
    )
    # only distinct methods are used, so the reservation is a semi join
    collected = t.collections.join(live, "reservation_id", "left_semi").select("cobra_id", "channel_id")
    methods = (
        schedules.join(intentions, "payment_schedule_id").join(scheduled, "payment_intention_id")
        .join(collected, "cobra_id").select("transaction_id", F.col("channel_id").alias("_m"), F.when(F.col("_late"), F.col("channel_id")).alias("_l"))
    ).where(F.col("transaction_id").isNotNull())

    def partner(column: str) -> Column:
        found = F.collect_set(column)
        combined = (F.size(found) >= 2) & F.array_contains(found, fixed.WALLET_CHANNEL)
        return F.when(combined, member_list(column, fixed.WALLET_CHANNEL))

    grouped = methods.groupBy(F.col("transaction_id").alias("transaction_code")).agg(
        partner("_m").alias("partner_before"), partner("_l").alias("partner")
    )
    return grouped.where(F.col("partner_before").isNotNull())


def wallet_base(t: Tables, s: Settings) -> DataFrame:
    """Confirmed payments of the launched countries, from 60 days before the first launch: what the wallet metrics look at.

    transaction_code, d, c, gb, p, partner_before and partner (see ``wallet_methods``), and late: payment and transaction
    belong to months from that of the first launch on.
    """
    launch = min(s.wallet_launches.values())
    since = launch - timedelta(days=fixed.WALLET_PRE_DAYS)
    month, late_month = (F.lit(day.replace(day=1)) for day in (since, launch))
    transactions = exclude_test(
        t.transactions.where((F.col("reservation_year_month") >= month) & F.col("channel").isin(*s.channels)),
        "agency_fantasy_name",
    ).select("transaction_code", F.col("partner_data_id").alias("p"), (F.col("reservation_year_month") >= late_month).alias("_late"))
    payments = t.payments.where(
        (F.col("reservation_year_month") >= month) & (F.col("is_confirmed_flg") == 1) & F.col("country_code").isin(*s.wallet_launches)
    ).select(
        "transaction_code", F.col("reservation_date").alias("d"), F.col("country_code").alias("c"),
        money("gross_booking").alias("gb"), (F.col("reservation_year_month") >= late_month).alias("_late_payment"),
    ).where(F.col("d") >= F.lit(since))
    rows = payments.join(transactions, "transaction_code").join(wallet_methods(t, s, since, launch), "transaction_code", "left")
    return rows.select(
        "transaction_code", "d", "c", "gb", "p", "partner_before", "partner", (F.col("_late") & F.col("_late_payment")).alias("late")
    )


def wallet_daily(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Per day and country: bookings and value with the wallet combination, and all; from 60 days before the launch.

    ``base``: a stored ``wallet_base``, also in the next two.
    """
    rows = wallet_base(t, s) if base is None else base
    with_wallet = F.col("partner_before").isNotNull()
    out = entity_counts(
        rows, ["d", "c"], {"nw": ("transaction_code", with_wallet), "nt": ("transaction_code", None)},
        {"gw": F.when(with_wallet, F.col("gb")), "gt": F.col("gb")},
    )
    return _round_sums(out, "gw", "gt").select(dates.iso_text("d").alias("d"), "c", "nw", "gw", "nt", "gt")


def _wallet_scope(t: Tables, s: Settings, base: DataFrame | None) -> DataFrame:
    rows = wallet_base(t, s) if base is None else base
    return rollout.since_launch(rows.where("late"), s.wallet_launches)


def wallet_agencies(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Agencies with the wallet combination and with any sale since each launch, per country and in all."""
    out = entity_counts(
        _wallet_scope(t, s, base), ["c"], {"agw": ("p", F.col("partner").isNotNull()), "agt": ("p", None)},
        totals=("c", {TOTAL: None}),
    )
    return keep_total_rows(out, "c", [TOTAL], ["agw", "agt"])


def wallet_mix(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """What the wallet is combined with: bookings and value per country and method set."""
    rows = _wallet_scope(t, s, base).where(F.col("partner").isNotNull())
    out = entity_counts(rows, ["c", "partner"], {"n": ("transaction_code", None)}, {"gb": F.col("gb")})
    return _round_sums(out, "gb")


# Deferred payment, packages and price grid ----------------------------------------------------------------------------


def pd_daily(t: Tables, s: Settings) -> DataFrame:
    """Daily bookings and value of the country with deferred payment since its launch."""
    launch = s.deferred_launch
    rows = sales_since(t.sales, launch.strftime("%Y-%m"), s.channels).where(
        (F.col("creation_date") >= F.lit(launch)) & (F.col("country_code") == s.deferred_country)
        & (F.col("transaction_status") == fixed.CONFIRMED)
    )
    out = entity_counts(rows, ["creation_date"], {"n": ("transaction_code", None)}, {"gb": money("gb")})
    return _round_sums(out, "gb", digits=2).select(dates.iso_text("creation_date").alias("d"), "n", "gb")


def with_flow(sales: DataFrame, t: Tables, *flows: str) -> DataFrame:
    """Sale lines whose reservation was made in one of the shopping flows."""
    reservations = latest_reservations(t.reservations).where(F.col("shopping_flow_source").isin(*flows)).select(
        F.col("id").alias("_id"), "shopping_flow_source"
    )
    keyed = sales.withColumn("_id", F.col("transaction_code").cast("string"))
    return keyed.join(reservations, "_id")


def pkg_daily(t: Tables, s: Settings) -> DataFrame:
    """Package sale per day and country, in all and by deferred payment, from 16 weeks before the launch."""
    since = s.deferred_launch - timedelta(days=7 * max(fixed.FIT_WINDOWS))
    sales = channel_sales(t, s, since).where(
        (F.col("transaction_status") == fixed.CONFIRMED) & F.col("country_code").isin(*s.package_countries)
    ).select("origin_product_id", "creation_date", "country_code", "transaction_code", money("gb").alias("gb"))
    rows = with_product(with_flow(sales, t, fixed.PACKAGE_FLOW), t, "payment_methods", probe=sales)
    deferred = F.col("payment_methods") == "DEFERRED_PAYMENT"
    out = entity_counts(
        rows, ["creation_date", "country_code"],
        {"n": ("transaction_code", None), "n_pd": ("transaction_code", deferred)},
        {"gb": F.col("gb"), "gb_pd": F.when(deferred, F.col("gb"))},
    )
    return _round_sums(out, "gb", "gb_pd").select(
        dates.iso_text("creation_date").alias("d"), F.col("country_code").alias("c"), "gb", "n", "gb_pd", "n_pd"
    )


def gv_daily(t: Tables, s: Settings) -> DataFrame:
    """Flight sale per day and country, alone and from the cart, from ten weeks before the launch."""
    since = s.grid_launch - timedelta(days=7 * fixed.GRID_PRE_WEEKS)
    sales = channel_sales(t, s, since).where(
        (F.col("transaction_status") == fixed.CONFIRMED) & (F.col("product") == fixed.FLIGHTS)
        & F.col("country_code").isin(*s.grid_countries)
    ).select("origin_product_id", "creation_date", "country_code", "transaction_code", money("gb").alias("gb"))
    rows = with_flow(sales, t, "FLIGHT", "CART")
    alone, cart = F.col("shopping_flow_source") == "FLIGHT", F.col("shopping_flow_source") == "CART"
    out = entity_counts(
        rows, ["creation_date", "country_code"], {"n_f": ("transaction_code", alone), "n_c": ("transaction_code", cart)},
        {"gb_f": F.when(alone, F.col("gb")), "gb_c": F.when(cart, F.col("gb"))},
    )
    return _round_sums(out, "gb_f", "gb_c").select(
        dates.iso_text("creation_date").alias("d"), F.col("country_code").alias("c"), "gb_f", "n_f", "gb_c", "n_c"
    )


def gv_ctr(t: Tables, s: Settings, *grains: str) -> DataFrame:
    """Visits shown the price grid and clicking in it, per grain, period and country; one scan for all grains."""
    return funnel.click_through(
        t.traffic, t.flight_events, s.channels, s.grid_countries, s.grid_launch, grains or ("d", "w", "m", "t")
    )


# Payment promise ------------------------------------------------------------------------------------------------------


def promised_ids(t: Tables, s: Settings, since: date, until: date | None = None) -> DataFrame:
    """Ids of the reservations made with a payment promise."""
    promised = t.deferred.where(F.col("reason") == fixed.PROMISE_REASON).select(F.col("reservation_id").alias("oid"))
    reservations = latest_reservations(t.reservations).where(
        F.col("channel").startswith(s.channel_prefix) & (F.col("date") >= F.lit(since))
    )
    if until is not None:
        reservations = reservations.where(F.col("date") < F.lit(until))
    return reservations.join(promised, "oid", "left_semi").select(F.col("id").alias("_id")).distinct()


def product_group() -> Column:
    return recode("product", fixed.PROMISE_GROUPS, fixed.OTHER_GROUP)


def _promise_window(t: Tables, s: Settings) -> DataFrame:
    """Sale lines of as many days before the promise launch as have passed since."""
    _, since = calendar.symmetric_window(s.promise_launch, s.as_of)
    return channel_sales(t, s, since).where(F.col("creation_date") < F.lit(s.as_of)).select(
        F.col("creation_date").alias("d"), F.col("country_code").alias("c"), F.col("partner_id").alias("p"),
        F.col("transaction_code").alias("tx"), product_group().alias("g"),
        recode("transaction_status", fixed.STATUS_CODES).alias("st"), money("gb").alias("gb"), "origin_product_id",
        F.col("transaction_code").cast("string").alias("_id"),
    ).where(F.col("st").isNotNull())


def promise_lines(t: Tables, s: Settings) -> DataFrame:
    """The sale lines that the promise metrics look at: d, c, p, tx, g, st, gb, origin_product_id, prom, nw.

    Lines without promise are kept when confirmed or active, or of a new product group.
    """
    _, since = calendar.symmetric_window(s.promise_launch, s.as_of)
    rows = flag_join(_promise_window(t, s), promised_ids(t, s, since), "_id", "prom").drop("_id")
    new = F.col("g").isin(*fixed.NEW_GROUPS)
    return rows.where((F.col("prom") == 1) | F.col("st").isin("C", "A") | new).withColumn("nw", new.cast("int"))


def promise_sales(t: Tables, s: Settings, payment: bool = False, base: DataFrame | None = None) -> DataFrame:
    """``promise_lines`` without the booked product: d, c, p, tx, g, st, gb, prom, nw. ``base``: them, stored.

    ``payment`` adds pmt and cr from the booked product.
    """
    rows = promise_lines(t, s) if base is None else base
    columns = ["d", "c", "p", "tx", "g", "st", "gb", "prom", "nw"]
    if not payment:
        return rows.select(*columns)
    probe = _promise_window(t, s) if base is None else base
    rows = with_product(rows, t, "payment_methods", "cancellation_reason", probe=probe)
    return rows.select(*columns, F.col("payment_methods").alias("pmt"), F.col("cancellation_reason").alias("cr"))


def pp_a(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Sale per day, country, product group, status and promise; TT holds the distinct bookings of all groups.

    ``base``: stored ``promise_lines``, also in the other promise metrics.
    """
    out = entity_counts(
        promise_sales(t, s, base=base), ["d", "c", "g", "st", "prom"], {"n": ("tx", None)}, {"gb": F.col("gb")},
        totals=("g", {fixed.ALL_GROUPS: None}),
    )
    return _round_sums(out, "gb").withColumn("d", dates.iso_text("d"))


def promise_method() -> Column:
    pmt = F.col("pmt")
    return classify(
        [
            (F.col("prom") == 1, "Promesa de pago"), (pmt.contains("REMOTE"), "Link de pago"),
            (pmt.contains("CREDIT_CARD"), "Tarjeta crédito"), (pmt.contains("DEBIT"), "Tarjeta débito"),
            (pmt == "CASH", "Efectivo"), (pmt == "AGENCY_ACCOUNT", "Cuenta de la agencia"), (pmt == "WALLET", "Wallet"),
            (pmt.startswith("DEFERRED"), "Diferido / gestor"),
        ],
        fixed.OTHERS,
    )


def pp_m(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Payment mix of the confirmed bookings of new products; a promise counts as such whatever paid it later."""
    rows = promise_sales(t, s, payment=True, base=base).where((F.col("st") == "C") & (F.col("nw") == 1))
    rows = rows.withColumn("m", promise_method())
    out = entity_counts(rows, ["d", "c", "m"], {"n": ("tx", None)}, {"gb": F.col("gb")})
    return _round_sums(out, "gb").withColumn("d", dates.iso_text("d"))


def cancel_reason() -> Column:
    cr = F.col("cr")
    return classify(
        [
            (cr == "AGENCY_CANCELED", "Cancela la agencia"), (cr.startswith("TIMEOUT"), "Vence sin pago"),
            (cr == "BOOKING_ERROR", "Error de reserva"),
        ],
        fixed.OTHERS,
    )


def pp_x(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Reasons of the cancelled bookings with promise."""
    rows = promise_sales(t, s, payment=True, base=base).where((F.col("st") == "X") & (F.col("prom") == 1))
    group = classify([(F.col("nw") == 1, "NU"), (F.col("g").isin(*fixed.KNOWN_GROUPS), "HO")], "OT")
    rows = rows.withColumns({"g2": group, "r": cancel_reason()})
    return entity_counts(rows, ["d", "c", "g2", "r"], {"n": ("tx", None)}).withColumn("d", dates.iso_text("d"))


def pp_ctl(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Per agency with confirmed new products: bookings and value before and after the launch, and its promise use."""
    launch = F.lit(s.promise_launch)
    new = F.col("nw") == 1
    confirmed = (F.col("st") == "C") & new
    before, after = F.col("d") < launch, F.col("d") >= launch
    promised = new & (F.col("prom") == 1) & after
    out = entity_counts(
        promise_sales(t, s, base=base), ["p"],
        {
            "pre_n": ("tx", confirmed & before), "post_n": ("tx", confirmed & after),
            "post_prom": ("tx", F.col("st").isin("C", "A") & promised), "post_prom_c": ("tx", (F.col("st") == "C") & promised),
            "_any": ("tx", confirmed),
        },
        {"pre_gb": F.when(confirmed & before, F.col("gb")), "post_gb": F.when(confirmed & after, F.col("gb"))},
        {"c": F.col("c")},
    ).where(F.col("_any") > 0)
    return _round_sums(out, "pre_gb", "post_gb").select(
        "p", "c", "pre_n", "pre_gb", "post_n", "post_gb", "post_prom", "post_prom_c"
    )


def promise_history(t: Tables, s: Settings) -> DataFrame:
    """Agencies that used the promise before the comparison window."""
    _, until = calendar.symmetric_window(s.promise_launch, s.as_of)
    ids = promised_ids(t, s, s.promise_history_from, until)
    sales = exclude_test(
        sales_since(t.sales, s.promise_history_from.strftime("%Y-%m"), s.channels).where(F.col("creation_date") < F.lit(until)),
        "agency_name",
    ).select(F.col("partner_id").alias("p"), F.col("transaction_code").cast("string").alias("_id"))
    return sales.join(ids, "_id", "left_semi").select("p").distinct()


def pp_ag(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Per agency using the promise: its bookings before and after, old and new products, active and confirmed."""
    launch = F.lit(s.promise_launch)
    before, after = F.col("d") < launch, F.col("d") >= launch
    promised = F.col("prom") == 1
    old, new = promised & (F.col("nw") == 0), promised & (F.col("nw") == 1)
    active, confirmed = F.col("st") == "A", F.col("st") == "C"
    counts = {
        "pre_h_a": old & before & active, "pre_h_c": old & before & confirmed,
        "post_h_a": old & after & active, "post_h_c": old & after & confirmed,
        "post_n_a": new & after & active, "post_n_c": new & after & confirmed,
        "act_pre": confirmed & before, "_any": promised & (active | confirmed),
    }
    agencies = entity_counts(
        promise_sales(t, s, base=base), ["p"], {name: ("tx", predicate) for name, predicate in counts.items()}, maxima={"c": F.col("c")}
    ).where(F.col("_any") > 0)
    history = promise_history(t, s).withColumn("hist_prom", F.lit(1))
    out = agencies.join(history, "p", "left").withColumn("hist_prom", F.coalesce("hist_prom", F.lit(0)))
    return out.select("p", "c", *[n for n in counts if n not in ("_any",)], "hist_prom")


def pp_agw(t: Tables, s: Settings, base: DataFrame | None = None) -> DataFrame:
    """Agencies using the promise per seven-day block from the launch."""
    rows = promise_sales(t, s, base=base).where(F.col("prom") == 1).withColumn("w", dates.block_index("d", F.lit(s.promise_launch)))
    return entity_counts(
        rows, ["w"], {"ag_ac": ("p", F.col("st").isin("A", "C")), "ag_c": ("p", F.col("st") == "C")}
    )


#: What several metrics are derived from; a board stores it once and hands it to each of them.
BASES = {
    "wallet_daily": wallet_base, "wallet_agencies": wallet_base, "wallet_mix": wallet_base,
    "pp_a": promise_lines, "pp_m": promise_lines, "pp_x": promise_lines, "pp_ctl": promise_lines, "pp_ag": promise_lines,
    "pp_agw": promise_lines,
}
