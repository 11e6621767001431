"""Small fixed tables: targets, calendars, launches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Literal rows up to here are marked for broadcast; longer lists are tables like others.
SMALL_ROWS = 10_000


def inline(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A table from literal rows; short ones are marked for broadcast."""
    if len(rows) > SMALL_ROWS:
        return spark.createDataFrame([tuple(row) for row in rows], schema)
    fields = T._parse_datatype_string(schema).fields
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [
        F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(row, fields)])
        for row in rows
    ]
    return F.broadcast(spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs))))
