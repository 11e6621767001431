"""Places of rows in an order, without one task for all of them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.operators.tables import inline
from kpiloom.session import scratch_path

#: monotonically_increasing_id holds the partition above these bits, and the row in it below.
ROW_BITS = 33


def with_places(rows: DataFrame, order: Sequence[Column], place: str) -> DataFrame:
    """``rows`` with their place in the order, from 1; equal rows are placed one after the other.

    Rows are dealt to partitions by range, sorted there and stored; then only the partitions' numbers of rows (one number
    per partition, on the driver) are added up.
    """
    if place in rows.columns:
        raise ValueError(f"a column is named {place}")
    spark = rows.sparkSession
    path = scratch_path(spark, "places")
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows.withColumn(place, F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(place, T.LongType())])).parquet(path)
    part = F.shiftright(place, ROW_BITS)
    sizes = sorted((r["part"], r["n"]) for r in stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    offsets = inline(spark, [(p, b) for (p, _), b in zip(sizes, before)], "_part long, _before long")
    row = F.col(place).bitwiseAND((1 << ROW_BITS) - 1)
    joined = stored.withColumn("_part", part).join(offsets, "_part")
    return joined.select(*rows.columns, (row + F.col("_before") + 1).alias(place))
