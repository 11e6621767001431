"""Shared helpers: staged tables, worker caches and Arrow batches."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.session import scratch_path

#: Bytes of an Arrow batch sent to Python.
BATCH_BYTES = 1 << 21


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends here, lost executors do no harm."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def named(name: str) -> Column:
    """A column by its whole name, which may hold dots and blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_rows(docs: DataFrame, **columns: Column) -> DataFrame:
    """``docs`` as one struct column ``row`` beside helper columns, so that no name of a user can meet one of a helper.

    ``select("row.*")`` gives the rows back as they were.
    """
    return docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in columns.items()])


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by bytes, as one text may hold megabytes (then it is a batch of its own)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, for what is costly to build; callers bound its size.

    A worker serves one operator at a time, so the caches of others go when an operator asks for its own.
    """
    kept = sys.modules.setdefault("_kpiloom_worker", types.ModuleType("_kpiloom_worker")).__dict__.setdefault("caches", {})
    for other in [k for k in kept if k != name]:
        del kept[other]
    return kept.setdefault(name, {})


def batches(rows: Iterable[tuple], schema: pa.Schema, max_rows: int = 2048, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of row tuples, cut by rows and by the bytes of their binary and text values."""
    columns: list[list] = [[] for _ in schema]
    count = size = 0
    for row in rows:
        for column, value in zip(columns, row):
            column.append(value)
            if isinstance(value, (bytes, str)):
                size += len(value)
        count += 1
        if count >= max_rows or size >= max_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            columns, count, size = [[] for _ in schema], 0, 0
    if count:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
