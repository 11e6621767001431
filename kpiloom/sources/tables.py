"""Input tables by role.

A role is a name the metrics use; where its table lives is the caller's business. Columns are the ones the metrics read,
in the types they compare them in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMAS: dict[str, str] = {
    "sales": (
        "transaction_code bigint, product_id bigint, origin_product_id string, partner_id string, agency_code string, "
        "agency_name string, country_code string, channel string, parent_channel string, product string, "
        "buy_type_code string, lob_gestion string, transaction_status string, creation_date date, gestion_date date, "
        "partition_period string, gb decimal(18,6)"
    ),
    "reservations": (
        "id string, oid string, status string, country_code string, channel string, last_version boolean, date date, "
        "shopping_flow_source string"
    ),
    "cancellations": "reservation_id string, type string",
    "deferred": "reservation_id string, reason string, deadline timestamp",
    "requests": "created_user string, creation_yearmonth string, creation_date date, transaction_code string",
    "transactions": (
        "transaction_code string, partner_data_id string, agency_code string, agency_fantasy_name string, "
        "channel string, parent_channel string, line_of_business string, reservation_year_month date, "
        "reservation_date date, confirmation_date timestamp, cancelation_date timestamp"
    ),
    "payroll": "ad_username string",
    "forecast": "fecha string, no_mes_proyectado string, producto string, pais string, lob_canal string, net_revenue string",
    "budget": "fecha string, no_mes_proyectado string, producto string, pais string, lob_canal string, net_revenue string",
    "profit": (
        "product_id bigint, transaction_code bigint, net_revenues_usd decimal(24,6), affiliates_usd decimal(24,6), "
        "line_of_business string, date_reservation_year_month string"
    ),
    "corrections": "product_id string",
    "marketing_funds": "product_id string",
    "marketing_funds_2": "product_id string",
    "quotations": "created_at timestamp, agency_code string, channel_code string",
    "products": (
        "transaction_id string, payment_methods string, refundable boolean, penalty_start_date date, "
        "cancellation_reason string"
    ),
    "schedules": "id string, transaction_id string, status string, created_at timestamp",
    "intentions": "id string, payment_schedule_id string, status string",
    "scheduled_collections": "payment_intention_id string, collectionId string",
    "collections": "cobra_id string, reservation_id string, channel_id string",
    "payments": (
        "transaction_code string, country_code string, reservation_date date, reservation_year_month date, "
        "gross_booking decimal(18,6), is_confirmed_flg int"
    ),
    "traffic": (
        "visit string, pageview_id string, product string, flow string, country string, channel string, date string, "
        "ispageview int, flg_detalle_cp int, is_bot int"
    ),
    "flight_events": (
        "datetime string, event struct<pageview_id: string, cc: string, type: string, code: string, fl: string, ft: string>"
    ),
    "map_a_events": "datetime string, event struct<pageview_id: string, filters: map<string,array<string>>>",
    "map_b_events": "datetime string, event struct<pageview_id: string, filters: map<string,array<string>>>",
    "array_events": (
        "datetime string, event struct<pageview_id: string, type: string, selected: string, "
        "event: struct<name: string, values: array<string>>>"
    ),
    "label_events": (
        "datetime string, event struct<pageview_id: string, action: string, label: string, data: map<string,string>>"
    ),
}

#: Tables joined to the revenue by product that no column is read from.
SIDE_TABLES = ("corrections", "marketing_funds", "marketing_funds_2")


class Tables:
    """Role tables as attributes, opened on first use."""

    def __init__(self, opener: Callable[[str], DataFrame]):
        self._opener = opener
        self._open: dict[str, DataFrame] = {}

    def __getattr__(self, role: str) -> DataFrame:
        if role.startswith("_"):
            raise AttributeError(role)
        if role not in self._open:
            self._open[role] = self._opener(role)
        return self._open[role]


def conform(df: DataFrame, role: str) -> DataFrame:
    """The columns of the role in their declared types.

    A text that is no whole number becomes NULL in a key (bigint), as such keys match nothing; ``rejected_keys`` lists
    these rows. Amounts, dates and all other values are cast strictly: one that does not fit fails the query.
    """
    fields = T._parse_datatype_string(SCHEMAS[role]).fields
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in fields if f.name not in have]
    if missing:
        raise ValueError(f"table for {role!r} lacks {', '.join(missing)}")
    return df.select(
        *[
            F.col(f.name) if have[f.name] == f.dataType
            else (F.col(f.name).try_cast(f.dataType) if f.dataType == T.LongType() else F.col(f.name).cast(f.dataType)).alias(f.name)
            for f in fields
        ]
    )


def rejected_keys(df: DataFrame, role: str) -> DataFrame:
    """Rows of a role's table in which a key is given but is no whole number: they lose it in ``conform``."""
    keys = [f.name for f in T._parse_datatype_string(SCHEMAS[role]).fields if f.dataType == T.LongType()]
    lost = F.lit(False)
    for k in keys:
        lost = lost | (F.col(k).isNotNull() & F.col(k).cast("string").try_cast("bigint").isNull())
    return df.where(lost)


def open_tables(spark: SparkSession, locations: Mapping[str, str], fmt: str = "parquet") -> Tables:
    """Roles from paths (anything with a slash) or catalog table names."""

    def opener(role: str) -> DataFrame:
        if role not in locations:
            raise KeyError(f"no location given for table {role!r}")
        place = locations[role]
        df = spark.read.format(fmt).load(place) if "/" in place else spark.table(place)
        return conform(df, role)

    return Tables(opener)


def read_sheet(spark: SparkSession, path: str, role: str = "forecast") -> DataFrame:
    """A text sheet saved as CSV with a header, for ``Tables``; every column stays text."""
    return spark.read.schema(SCHEMAS[role]).option("header", True).csv(path)


def latest_reservations(reservations: DataFrame) -> DataFrame:
    return reservations.where(F.col("last_version"))


def sales_since(sales: DataFrame, period: str, channels=None) -> DataFrame:
    """Sales of the periods from ``period`` on; the predicate prunes a table partitioned by ``partition_period``."""
    out = sales.where(F.col("partition_period") >= period)
    return out if channels is None else out.where(F.col("channel").isin(*channels))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys of a side table that occur more than once, with their number: a join with it would multiply rows."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def repeated_side_keys(t: Tables) -> DataFrame:
    """Repeated keys of the side tables that the revenue leaves out (role, product_id, n); empty if that is right."""
    parts = [repeated_keys(getattr(t, role), "product_id").select(F.lit(role).alias("role"), "product_id", "n") for role in SIDE_TABLES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
