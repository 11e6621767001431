"""Joins of fact tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Heavy keys are estimated from one row in so many, and split into parts of so many rows.
SLICES = 64
ROWS_PER_PART = 2_000_000


def heavy_keys(rows: DataFrame, on: str, rows_per_part: int) -> DataFrame:
    """Heavy keys of ``rows`` and the number of parts each should be split into: _key, _parts.

    Keys are counted in a slice of the rows (by the hash of all their columns), so every use sees the same keys. Each
    listed key stands for more than ``rows_per_part`` rows by that estimate, which bounds their number.
    """
    counted = (
        rows.where(F.col(on).isNotNull() & (F.pmod(F.xxhash64(*rows.columns), F.lit(SLICES)) == 0))
        .groupBy(F.col(on).alias("_key"))
        .agg((F.count("*") * SLICES).alias("_n"))
    )
    return counted.where(F.col("_n") > rows_per_part).select("_key", F.ceil(F.col("_n") / rows_per_part).cast("int").alias("_parts"))


def skew_join(
    left: DataFrame, right: DataFrame, on: str, how: str, probe: DataFrame | None = None, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """Equi join of a fact with its foreign key, which may have hot values (or many NULLs) on the left side.

    A key with more than about ``rows_per_part`` left rows is split by the hash of the row; the matching right rows are
    repeated once per part. NULL keys match nothing, so they are only spread. The heavy keys decide the layout only: the
    result equals that of the plain join for ``how`` in inner, left, left_semi and left_anti. A left side that is distinct
    in the key, or joined by its own id, needs no splitting; Spark's own skew handling is enough for it.

    ``probe`` is a cheaper frame with the key to look for heavy keys in (for instance the bare scan).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    if how in ("inner", "left_semi"):  # as heavy_keys does, so that both read the same shuffle
        left = left.where(F.col(on).isNotNull())
    # one entry per rows_per_part rows at most: a few megabytes for 10^12 rows
    heavy = F.broadcast(heavy_keys(left if probe is None else probe, on, rows_per_part))
    is_heavy = F.col(on) == F.col("_key")
    spread = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = F.coalesce(F.col("_parts"), F.when(F.col(on).isNull(), F.lit(spread)), F.lit(1))
    salt = F.pmod(F.xxhash64(F.lit(7), *left.columns), parts).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    salted_left = left.join(heavy, is_heavy, "left").select(*left.columns, salt.alias("_salt"))
    salted_right = right.where(F.col(on).isNotNull()).join(heavy, is_heavy, "left").select(*right.columns, copies.alias("_salt"))
    return salted_left.join(salted_right, [on, "_salt"], how).drop("_salt")


def flag_join(left: DataFrame, keys: DataFrame, on: str, flag: str, split: bool = False, probe: DataFrame | None = None) -> DataFrame:
    """``flag`` = 1 where the key occurs in ``keys``, else 0; ``keys`` are made unique first so no row is multiplied.

    ``split``: the key is a foreign key that may be hot (``skew_join``).
    """
    marked = keys.select(on).distinct().withColumn(flag, F.lit(1))
    joined = skew_join(left, marked, on, "left", probe) if split else left.join(marked, on, "left")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def on_spine(spine: DataFrame, facts: DataFrame, on: str | Sequence[str], zero: Sequence[str] = ()) -> DataFrame:
    """Every spine row is kept; the columns in ``zero`` become 0 where there are no facts."""
    out = spine.join(facts, on, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero})
