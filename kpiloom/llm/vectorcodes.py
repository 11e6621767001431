"""Vector codes: each part of a vector is named by its nearest entry in the codebook of its place.

Vectors become whole numbers and are stored in blocks. A block keeps, for each dimension, a dictionary of the distinct
numbers in it and the rows' places in that dictionary. Distances need no arithmetic on rows: for every dimension the
squared differences of the distinct numbers to all entries are tabulated, and a row's distance is gathered from these
tables by its dictionary codes and added up over the dimensions of a part. Sums per entry are counts of dictionary codes
times their numbers. Codebooks have a fixed size; nothing else leaves the tasks but sums, one row per entry and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import small_batches, staged

#: Numbers beyond this would make squared distances that no long can hold.
MOST = 1 << 26
#: Rows gathered at once.
STEP = 1024
#: Shares into which a label's rows are dealt.
SALTS = 64


@dataclass(frozen=True)
class Codebooks:
    """Entries (entry, dimension) of whole numbers; part p holds the dimensions bounds[p] to bounds[p + 1]."""

    entries: np.ndarray
    bounds: tuple[int, ...]

    def text(self) -> str:
        """All components by part, entry and place in the part, joined by commas."""
        parts = [self.entries[:, a:b] for a, b in zip(self.bounds, self.bounds[1:])]
        return ",".join(str(x) for part in parts for x in part.ravel().tolist())

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def whole(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))


def usable(vector: Column, scale: int) -> Column:
    """No null, no component that is null, not finite, or too large for distances in a long."""
    limit = float(MOST / scale)
    return vector.isNotNull() & F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(limit))
    )


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The vectors of the smallest ids as entries; None without vectors. Rows: id, v (whole numbers)."""
    first = vectors.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()  # a codebook
    if not first:
        return None
    dims = len(first[0]["v"])
    own = [r["v"] for r in first if len(r["v"]) == dims]
    return Codebooks(np.array(own, np.int64).reshape(len(own), dims), tuple(p * dims // parts for p in range(parts + 1)))


def in_blocks(vectors: DataFrame, dims: int) -> DataFrame:
    """Stored blocks of rows (id, label, v): ids, labels, and per dimension its dictionary and the rows' codes."""
    small_batches(vectors.sparkSession)
    id_type, label_type = (vectors.schema[c].dataType.simpleString() for c in ("id", "label"))

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, dims)
            sizes, numbers, codes = np.empty(dims, "<i4"), [], np.empty((dims, n), "<u2")
            for d in range(dims):
                distinct, codes[d] = np.unique(x[:, d], return_inverse=True)
                sizes[d] = len(distinct)
                numbers.append(distinct)
            blob = [sizes.tobytes(), (np.concatenate(numbers) if dims else np.empty(0)).astype("<i8").tobytes(), codes.tobytes()]
            ids, labels = (pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(c)) for c in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [ids, labels, pa.array([n]), *(pa.array([b], pa.binary()) for b in blob)],
                ["ids", "labels", "n", "sizes", "numbers", "codes"],
            )

    kind = f"ids array<{id_type}>, labels array<{label_type}>, n long, sizes binary, numbers binary, codes binary"
    return staged(vectors.select("id", "label", "v").mapInArrow(run, kind), "vector-blocks")


class Block:
    """A stored block: for each dimension its distinct numbers and the rows' codes."""

    def __init__(self, n: int, sizes: bytes, numbers: bytes, codes: bytes) -> None:
        ends = np.cumsum(np.frombuffer(sizes, "<i4"))
        self.n, self.numbers = n, np.split(np.frombuffer(numbers, "<i8"), ends[:-1]) if len(ends) else []
        self.codes = np.frombuffer(codes, "<u2").reshape(len(ends), n)

    def assign(self, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each part (part, row), the lower one on ties, and each row's distances added up."""
        parts = list(zip(books.bounds, books.bounds[1:]))
        nearest, error = np.zeros((len(parts), self.n), np.int64), np.zeros(self.n, np.int64)
        for p, (a, b) in enumerate(parts):
            distance = np.zeros((self.n, len(books.entries)), np.int64)
            for d in range(a, b):
                table = np.square(self.numbers[d][:, None] - books.entries[None, :, d])
                for at in range(0, self.n, STEP):
                    distance[at : at + STEP] += table[self.codes[d, at : at + STEP]]
            nearest[p] = distance.argmin(axis=1)
            error += distance[np.arange(self.n), nearest[p]]
        return nearest, error

    def sums(self, books: Codebooks, total: np.ndarray, count: np.ndarray) -> None:
        """Add this block's numbers per entry and dimension, and rows per part and entry."""
        nearest, _ = self.assign(books)
        k = len(books.entries)
        for p, (a, b) in enumerate(zip(books.bounds, books.bounds[1:])):
            count[p] += np.bincount(nearest[p], minlength=k)
            for d in range(a, b):
                numbers = self.numbers[d]
                met = np.bincount(nearest[p] * len(numbers) + self.codes[d], minlength=k * len(numbers)).reshape(k, -1)
                total[:, d] += met @ numbers


def improved(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry becomes the floor of the mean of the parts nearest to it; an entry without parts stays."""
    k, dims, parts = *books.entries.shape, len(books.bounds) - 1

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count, seen = np.zeros((k, dims), np.int64), np.zeros((parts, k), np.int64), False
        for batch in given:
            for row in batch.to_pylist():
                Block(**row).sums(books, total, count)
                seen = True
        if seen:  # part -1 holds the sums by dimension, the others their counts
            for place, own in [*((d, total[:, d]) for d in range(dims)), *((-1 - p, count[p]) for p in range(parts))]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, place)), pa.array(np.arange(k)), pa.array(own)], ["place", "entry", "n"]
                )

    sums = blocks.select("n", "sizes", "numbers", "codes").mapInArrow(run, "place long, entry long, n long")
    merged = sums.groupBy("place", "entry").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n"))
    found = {(r["place"], r["entry"]): int(r["n"]) for r in merged.collect()}  # as large as the codebooks
    entries = books.entries.copy()
    for p, (a, b) in enumerate(zip(books.bounds, books.bounds[1:])):
        for e in range(k):
            if n := found.get((-1 - p, e), 0):
                entries[e, a:b] = [found[d, e] // n for d in range(a, b)]
    return Codebooks(entries, books.bounds)


def coded(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """Rows id, label, code (the entries' numbers, two hex digits each, in part order), error (distances added up)."""
    id_type, label_type = (blocks.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels"))
    width = 2 if len(books.entries) <= 256 else 4

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for i in range(batch.num_rows):
                n, sizes, numbers, codes = (batch.column(c)[i].as_py() for c in range(2, 6))
                nearest, error = Block(n, sizes, numbers, codes).assign(books)
                text = np.ascontiguousarray(nearest.T.astype("u1" if width == 2 else ">u2")).tobytes().hex()
                size = len(text) // n
                names = pa.array([text[r * size : (r + 1) * size] for r in range(n)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i].values, batch.column(1)[i].values, names, pa.array(error)],
                    ["id", "label", "code", "error"],
                )

    return blocks.mapInArrow(run, f"id {id_type}, label {label_type}, code string, error long")


def compress(
    vectors: DataFrame, *, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, Codebooks | None]:
    """Coded rows (id, label, code, error; stored) and the codebooks they refer to.

    Components become floor(scale * x). A vector is cut into ``parts`` consecutive parts, equal where their number divides
    its length. The codebooks start as the parts of the vectors with the smallest ids (null ids last, equal ids by their
    numbers), fewer than ``entries`` if there are fewer vectors, and are improved ``rounds`` times; ties go to the lower
    entry. Left out: vectors that are null or hold a null or non-finite component, or one so large that a squared distance
    fits no long (2**26 after scaling), and vectors of another length than that of the smallest id. Repeated rows stay rows
    of their own; empty vectors get entry 0 and no error. An empty table gives no rows and no codebooks. Other columns are
    not read.
    """
    spark = vectors.sparkSession
    given = vectors.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").alias("x")
    )
    rows = given.where(usable(F.col("x"), scale)).select("id", "label", whole(F.col("x"), scale).alias("v"))
    books = first_codebooks(rows, parts, entries)
    if books is None:
        kinds = f"id {rows.schema['id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}"
        return spark.createDataFrame([], f"{kinds}, code string, error long"), None
    dims = books.entries.shape[1]
    blocks = in_blocks(rows.where(F.size("v") == dims), dims)
    for _ in range(rounds):
        books = improved(blocks, books)
    return staged(coded(blocks, books), "vector-codes"), books


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` of ``compress`` with label_error, the errors of all rows of the label added up; null labels are one.

    Errors are added up per label first; the label's rows are dealt into ``SALTS`` shares before they meet the sum.
    """
    total = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    total = total.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = rows.withColumn("salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    same = dealt["label"].eqNullSafe(total["label"]) & (dealt["salt"] == total["salt"])
    return dealt.join(total, same).select(dealt["id"], dealt["label"], "code", "error", "label_error")
