"""Marks of what a source holds per period, to tell which periods have changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def period_marks(rows: DataFrame, period: Column, columns: Sequence[str]) -> DataFrame:
    """Per period: number of rows and the sum of their hashes over ``columns``, which does not depend on their order.

    Sums are merged map-side, so a row per period and task is shuffled. Columns may be nested and hold maps.
    """
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return rows.groupBy(period.alias("period")).agg(
        F.count("*").alias("n"), F.sum(F.xxhash64(text).cast("decimal(20,0)")).alias("mark")
    )
