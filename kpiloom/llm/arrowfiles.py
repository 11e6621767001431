"""Token ids in Arrow files of equal-length sequences, read back without a copy.

A file is an Arrow IPC file whose batches hold two fixed-size lists of ``window`` slots: ``ids`` and ``mask`` (1 where a
slot holds an id). Sequence ``i`` of a file lies in batch ``i // BATCH_SEQUENCES``, so any sequence, and any id, is found
by arithmetic. Only the last sequence of a file is padded. The manifest, a Parquet table, has a row per document: the
file, the slot it starts at and its number of ids. It names only files of tasks that ended well.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kpiloom.llm.common import batches, small_batches
from kpiloom.llm.tokens import encoder
from kpiloom.session import scratch_path

BATCH_SEQUENCES = 256
MANIFEST = "part long, file string, doc_id {id}, at long, n_tokens long"


class SequenceWriter:
    """Appends ids to a file, a batch of sequences at a time."""

    def __init__(self, path: str, window: int, dtype: np.dtype) -> None:
        from pyarrow import fs

        self.files, self.path = fs.FileSystem.from_uri(path)
        self.files.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.window, self.dtype, self.at = window, dtype, 0
        self.pending, self.held = [], 0
        ids, mask = pa.list_(pa.from_numpy_dtype(dtype), window), pa.list_(pa.bool_(), window)
        self.schema = pa.schema([("ids", ids), ("mask", mask)])
        self.sink = self.files.open_output_stream(self.path, compression=None)
        self.file = pa.ipc.new_file(self.sink, self.schema)

    def add(self, ids: bytes) -> int:
        """Append a document's ids; returns the slot of the first."""
        start, n = self.at, len(ids) // self.dtype.itemsize
        self.pending.append(ids)
        self.at += n
        self.held += n
        if self.held >= BATCH_SEQUENCES * self.window:
            self._write(self.held // (BATCH_SEQUENCES * self.window) * BATCH_SEQUENCES)
        return start

    def _write(self, sequences: int, n: int | None = None) -> None:
        flat = np.frombuffer(b"".join(self.pending), self.dtype)
        slots = sequences * self.window
        body = flat[:slots]
        if n is not None:
            body = np.concatenate([body, np.zeros(slots - n, self.dtype)])
        mask = np.arange(slots) < (slots if n is None else n)
        for first in range(0, slots, BATCH_SEQUENCES * self.window):
            cut = slice(first, min(slots, first + BATCH_SEQUENCES * self.window))
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x[cut]), self.window) for x in (body, mask)]
            self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.pending, self.held = [flat[slots:].tobytes()], max(0, len(flat) - slots)

    def close(self) -> None:
        if self.held:
            self._write(-(-self.held // self.window), self.held)
        self.file.close()
        self.sink.close()


class SequenceReader:
    """Ids of a file by slot; a local file is mapped into memory, so nothing is copied before it is asked for."""

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        files, inner = fs.FileSystem.from_uri(path)
        self.source = pa.memory_map(inner) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(inner)
        self.file = pa.ipc.open_file(self.source)
        self.window = self.file.schema.field("ids").type.list_size
        self.last: tuple[int, np.ndarray] = (-1, np.empty(0))

    def batch(self, k: int) -> np.ndarray:
        if self.last[0] != k:
            self.last = (k, self.file.get_batch(k).column(0).values.to_numpy(zero_copy_only=True))
        return self.last[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``."""
        batch = self.file.get_batch(i // BATCH_SEQUENCES)
        cut = slice(i % BATCH_SEQUENCES * self.window, (i % BATCH_SEQUENCES + 1) * self.window)
        return batch.column(0).values.to_numpy()[cut], batch.column(1).values.to_numpy(zero_copy_only=False)[cut]

    def ids(self, at: int, n: int) -> Iterator[np.ndarray]:
        """The ids of slots ``at`` to ``at + n``, batch by batch."""
        size = BATCH_SEQUENCES * self.window
        while n > 0:
            values = self.batch(at // size)[at % size : at % size + n]
            yield values
            at, n = at + len(values), n - len(values)

    def close(self) -> None:
        self.last = (-1, np.empty(0))
        self.source.close()


def write_sequences(
    docs: DataFrame,
    vocabulary: str,
    *,
    path: str | None = None,
    window: int = 2048,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    parts: int | None = None,
) -> str:
    """Encode all rows and write their ids, by ascending id, to Arrow files below ``path``; returns ``path``.

    Rows are dealt by ranges of (id, hash of the text), so equal or null ids (first) may fill many tasks; rows that are
    equal in both are in any order. Every row gets ``end_id``, also for a null or empty text. Files hold 16-bit ids where
    the vocabulary allows, else 32-bit. A retried task writes another file; only named files count. Columns other than
    the two named are not read; an empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = path or scratch_path(spark, "sequences")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    id_type = dealt.schema["doc_id"].dataType
    schema = pa.schema(
        [("part", pa.int64()), ("file", pa.string()), ("doc_id", to_arrow_type(id_type)), ("at", pa.int64()), ("n_tokens", pa.int64())]
    )

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        end = np.array([end_id], own.dtype).tobytes()
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.arrow"
        writer = None

        def placed() -> Iterator[tuple]:
            nonlocal writer
            for batch in given:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    writer = writer or SequenceWriter(f"{path}/files/{name}", window, own.dtype)
                    ids = own.encode(text) + end
                    yield part, name, doc_id, writer.add(ids), len(ids) // own.dtype.itemsize
            if writer:
                writer.close()

        yield from batches(placed(), schema, max_rows=4096)

    dealt.mapInArrow(run, MANIFEST.format(id=id_type.simpleString())).write.parquet(f"{path}/manifest")
    return path


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The documents of ``path``: part, file, doc_id, at (slot in the file), n_tokens, start (ids of all before it)."""
    rows = spark.read.parquet(f"{path}/manifest")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row per file
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return rows.join(before, "part").withColumn("start", F.col("before") + F.col("at")).drop("before")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers)."""
    rows = read_manifest(spark, path)
    id_type = rows.schema["doc_id"].dataType
    schema = pa.schema([("doc_id", to_arrow_type(id_type)), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    files = max(1, rows.select("file").distinct().count())
    by_file = rows.repartition(files, "file").sortWithinPartitions("file", "at").select("file", "doc_id", "at", "start", "n_tokens")

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[tuple]:
            name, reader = None, None
            for batch in given:
                for file, doc_id, at, start, n in zip(*(c.to_pylist() for c in batch.columns)):
                    if file != name:
                        if reader:
                            reader.close()
                        name, reader = file, SequenceReader(f"{path}/files/{file}")
                    crc = 0
                    for values in reader.ids(at, n):
                        crc = zlib.crc32(values.astype("<u4").tobytes(), crc)
                    yield doc_id, start, n, crc
            if reader:
                reader.close()

        yield from batches(read(), schema, max_rows=4096)

    return by_file.mapInArrow(run, f"doc_id {id_type.simpleString()}, start long, n_tokens long, ids_crc32 long")
