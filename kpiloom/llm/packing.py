"""Packing of documents into windows of equal length by best-fit decreasing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kpiloom.llm.common import batches, named, small_batches
from kpiloom.llm.tokens import encoder

#: Documents and bytes of text packed together, some thousands of windows; a group ends with a few open ones, so the padding
#: stays near nothing.
GROUP_DOCUMENTS, GROUP_BYTES = 20_000, 32 << 20
#: Shares into which rows of equal id and length are dealt.
SALTS = 1024

TOKENS = "row_id {id}, n_tokens long, ids binary"
PIECES = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class OpenWindows:
    """Open windows by remaining capacity; a segment tree finds the tightest capacity that holds a length."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: dict[int, list[tuple[int, int]]] = {}

    def put(self, capacity: int, sequence: int, fill: int) -> None:
        if capacity:
            self.windows.setdefault(capacity, []).append((sequence, fill))
            self._add(capacity, 1)

    def take(self, length: int) -> tuple[int, int, int] | None:
        """Capacity, sequence and fill of the tightest open window for ``length``, which leaves the tree."""
        node = self.leaves + length
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):  # up, until a right sibling holds something
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        sequence, fill = self.windows[capacity].pop()
        self._add(capacity, -1)
        return capacity, sequence, fill

    def _add(self, capacity: int, n: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += n
            node >>= 1


def place(documents: Iterator[tuple], window: int, first_sequence: int) -> Iterator[tuple]:
    """Pieces (key, start, length, n, sequence, offset) of documents (key, n) that come by descending ``n % window``."""
    tree, sequence = OpenWindows(window), first_sequence
    for key, n in documents:
        full = n - n % window
        for start in range(0, full, window):
            yield key, start, window, n, sequence, 0
            sequence += 1
        if rest := n - full:
            found = tree.take(rest)
            if found is None:
                capacity, target, fill = window, sequence, 0
                sequence += 1
            else:
                capacity, target, fill = found
            yield key, full, rest, n, target, fill
            tree.put(capacity - rest, target, fill + rest)


def tokenized(docs: DataFrame, vocabulary: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Each row's ids with the end id: row_id, n_tokens, ids (16-bit little-endian where the vocabulary allows, else 32)."""
    small_batches(docs.sparkSession)
    rows = docs.select(named(id_col).alias("row_id"), named(text_col).alias("text"))
    kind = rows.schema["row_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        end = np.array([end_id], own.dtype).tobytes()
        for part in parts:
            ids = [own.encode(t) + end for t in part.column(1).to_pylist()]
            counts = [len(x) // own.dtype.itemsize for x in ids]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], ["row_id", "n_tokens", "ids"]
            )

    return rows.mapInArrow(run, TOKENS.format(id=kind))


def pack(
    docs: DataFrame,
    vocabulary: str,
    *,
    window: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_documents: int = GROUP_DOCUMENTS,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Pack all rows of ``docs`` into sequences of at most ``window`` ids.

    A document is its text's ids and ``end_id``. Documents of more than a window are first cut into full windows; what
    is left goes, by descending length, into the tightest open window. Groups of about ``group_documents`` rows or
    ``group_bytes`` of text, whichever is less, are packed independently; rows stream through a group in sorted order, so a
    task holds its open windows and nothing else. Rows are dealt by a hash of id, length and, as these may be equal for
    very many, their place in the input.

    Returns a row per piece: doc_id, start, length, ids (32-bit little-endian), doc_tokens, sequence_id, offset.
    Null or empty text: the end id alone. Null ids and repeated rows are packed like any other row, ties in any order.
    An empty table gives no rows. Columns other than the two named are not read.
    """
    tokens = tokenized(docs, vocabulary, end_id, id_col, text_col)
    n, size = docs.agg(F.count("*"), F.sum(F.octet_length(named(text_col)).cast("long"))).first()
    groups = max(1, -(-n // group_documents), -(-(size or 0) // group_bytes))
    salt = F.monotonically_increasing_id() % SALTS
    kind = tokens.schema["row_id"].dataType.simpleString()
    ordered = (
        tokens.withColumn("salt", salt)
        .repartition(groups, "row_id", "n_tokens", "salt")
        .withColumn("rest", F.col("n_tokens") % window)
        .sortWithinPartitions(F.desc("rest"), "n_tokens", "row_id")
        .select("row_id", "n_tokens", "ids")
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        rows = (((r, ids), n) for p in parts for r, n, ids in zip(*(c.to_pylist() for c in p.columns)))
        schema = None

        def pieces() -> Iterator[tuple]:
            for (row, ids), start, length, n, sequence, offset in place(rows, window, first):
                width = len(ids) // n
                cut = np.frombuffer(ids, f"<u{width}", length, start * width).astype("<u4").tobytes()
                yield row, start, length, cut, n, sequence, offset

        schema = pa.schema(
            [("doc_id", id_type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
            + [(c, pa.int64()) for c in ("doc_tokens", "sequence_id", "offset")]
        )
        yield from batches(pieces(), schema)

    id_type = to_arrow_type(tokens.schema["row_id"].dataType)
    return ordered.mapInArrow(run, PIECES.format(id=kind))


def sequences(pieces: DataFrame, window: int = 2048) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens, ids (the pieces in a row, padded with zero bytes to the window).

    A sequence holds at most a window of ids, so its group is bounded. Sequences come from ``pack``: none is null or empty,
    and each row is a piece of its own, whatever its id. Other columns are not read; an empty table gives no rows.
    """
    grouped = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    return grouped.select("sequence_id", "n_tokens", F.rpad(joined, 4 * window, F.lit(b"\x00").cast("binary")).alias("ids"))
