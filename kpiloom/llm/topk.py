"""Exact top-k search by inner product, by no-random-access aggregation over sorted lists.

A block of rows has one list per dimension, its rows sorted by their value. A query reads each list from the end that helps
it, in small steps, the same depth in all lists and never out of order. What it has not read of a row lies between the last
value read and the far end of the list; that gives each row a lower and an upper bound. A row whose upper bound is below
the k-th best lower bound, or below the k-th best score of a first pass over a small sample of rows, is out for good.
Nothing can be out before a row that no list has shown yet is out. Reading stops for a query when the rows still open are
few; their final scores are then resolved. While many rows are open the bounds of a block of queries are computed together, as products of matrices of whole numbers; a query with fewer open
rows goes on alone, with these. Every block of queries meets every block of rows; each pair yields at most k rows per
query, and the best k of these are the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from kpiloom.llm.common import batches, small_batches, staged

BLOCK_ROWS = 8192
BLOCK_QUERIES = 512
#: Steps in which a list is read.
STEPS = 16
#: A query whose open rows are at most so many times k reads no further; with at most this share of rows open it goes on alone.
FEW, ALONE = 4, 0.1
#: The sample whose scores give each query a first bound, in rows and in bytes. It decides how soon reading stops, not what is found.
SAMPLE_ROWS, SAMPLE_BYTES = 8192, 8 << 20

#: Stands for no score.
NONE = np.int64(-(1 << 62))

BLOCK = pa.schema(
    [("block", pa.int64()), ("shelf", pa.int64()), ("dims", pa.int64()), ("ids", pa.binary()), ("values", pa.binary())]
)


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null where the vector or a component is null or not finite, or it is empty."""
    fine = (F.size(vector) > 0) & F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf"))
    )
    return F.when(fine, F.transform(vector, lambda v: F.floor(F.lit(scale) * v.cast("double"))))


def packed(vectors: DataFrame, rows: int, name: str) -> DataFrame:
    """Rows (id, v: whole numbers) as stored blocks of vectors of equal length: block, shelf (dense), dims, ids, values."""
    small_batches(vectors.sparkSession)
    n = max(1, -(-vectors.count() // rows))

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: dict[int, list] = {}
        made = 0

        def block(dims: int) -> tuple:
            nonlocal made
            made += 1
            ids, values = zip(*held.pop(dims))
            return part << 32 | made, part % n, dims, np.concatenate(ids).tobytes(), np.concatenate(values).tobytes()

        def blocks() -> Iterator[tuple]:
            for batch in given:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                vectors = batch.column(1)
                sizes = np.diff(vectors.offsets.to_numpy())
                for dims in np.unique(sizes).tolist():
                    own = np.flatnonzero(sizes == dims)
                    values = vectors.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False)
                    held.setdefault(dims, []).append((ids[own], values))
                    if sum(len(i) for i, _ in held[dims]) >= 2 * rows:  # a part that got too much makes more blocks
                        yield block(dims)
            for dims in list(held):
                yield block(dims)

        yield from batches(blocks(), BLOCK, max_rows=8)

    dealt = vectors.select("id", "v").repartition(n, "id")
    return staged(dealt.mapInArrow(run, "block long, shelf long, dims long, ids binary, values binary"), name)


class Lists:
    """The sorted lists of a block of rows: by dimension, each row's place and the values in falling order."""

    def __init__(self, x: np.ndarray) -> None:
        n, dims = x.shape
        self.x, self.n = x, n
        order = np.argsort(-x, axis=0, kind="stable")
        self.falling = np.take_along_axis(x, order, 0)
        self.place = np.empty((n, dims), np.int32)
        np.put_along_axis(self.place, order, np.arange(n, dtype=np.int32)[:, None].repeat(dims, 1), 0)

    def depth(self, step: int) -> int:
        return -(-self.n * step // STEPS)

    def upper(self, q: np.ndarray, depth: int, rows: np.ndarray) -> np.ndarray:
        """Upper bound of the given rows' scores for each query after ``depth`` entries of each list."""
        x, place = self.x[rows], self.place[rows]
        high = np.maximum(q, 0) @ np.where(place < depth, x, self.falling[depth - 1]).T
        high += np.minimum(q, 0) @ np.where(place >= self.n - depth, x, self.falling[self.n - depth]).T
        return high

    def lower(self, q: np.ndarray, depth: int, rows: np.ndarray) -> np.ndarray:
        x, place = self.x[rows], self.place[rows]
        low = np.maximum(q, 0) @ np.where(place < depth, x, self.falling[-1]).T
        low += np.minimum(q, 0) @ np.where(place >= self.n - depth, x, self.falling[0]).T
        return low


class Reader:
    """Bounds of the open rows of one query, which reads each list from one end only."""

    def __init__(self, lists: Lists, q: np.ndarray, rows: np.ndarray) -> None:
        self.lists, self.q, self.rows, self.up = lists, q, rows, q >= 0
        self.place = np.where(self.up, lists.place[rows], lists.n - 1 - lists.place[rows])
        self.parts = lists.x[rows] * q
        self.least = np.where(self.up, lists.falling[-1], lists.falling[0]) * q

    def bounds(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """What has been read of a row, and the least and the most of what has not."""
        falling = self.lists.falling
        most = np.where(self.up, falling[depth - 1], falling[self.lists.n - depth]) * self.q
        read = (self.place < depth).astype(self.parts.dtype)
        seen = np.einsum("ij,ij->i", read, self.parts)
        missing = np.stack([self.least, most])
        unread = missing.sum(axis=1) - read @ missing.T
        return seen + unread[:, 0], seen + unread[:, 1]

    def keep(self, chosen: np.ndarray) -> None:
        self.rows, self.place, self.parts = self.rows[chosen], self.place[chosen], self.parts[chosen]


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; the least number of all with fewer than k."""
    if scores.shape[-1] < k:
        return np.full(scores.shape[:-1], NONE)
    found = np.partition(scores, scores.shape[-1] - k, axis=-1)[..., scores.shape[-1] - k]
    return np.where(np.isfinite(found), found, NONE).astype(np.int64)


def best(
    lists: Lists, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int, known: np.ndarray
) -> Iterator[tuple[int, int, int]]:
    """(number of the query, row id, score) of the rows of a block that can be among the k best of each query, k at most.

    ``known``: a score that k other rows reach, by query. A query's own rows are left out.
    """
    known, up, down = known.copy(), np.maximum(q, 0), np.minimum(q, 0)
    # the block as a whole: nothing is read where its largest values cannot reach what is known
    waiting = np.flatnonzero(up @ lists.falling[0] + down @ lists.falling[-1] >= known)
    rows, still = np.arange(lists.n), q_ids[waiting][:, None] != ids[None, :]  # which rows are open, by waiting query
    for step in range(1, STEPS + 1):
        if not len(waiting):
            return
        depth = lists.depth(step)
        # no row's upper bound is below that of a row which no list has shown yet: until that one is out, none is
        unseen = up[waiting] @ lists.falling[depth - 1] + down[waiting] @ lists.falling[lists.n - depth]
        ready = (unseen < known[waiting]) | (known[waiting] == NONE) | (step == STEPS)
        if not ready.any():
            continue
        now = waiting[ready]
        own = still if ready.all() else still[ready]
        bare = np.flatnonzero(known[now] == NONE)
        if len(bare):  # without a known score the k-th best lower bound is the first one
            known[now[bare]] = kth_best(np.where(own[bare], lists.lower(q[now[bare]], depth, rows), -np.inf), k)
        own &= lists.upper(q[now], depth, rows) >= known[now][:, None]
        few = np.count_nonzero(own, axis=1) <= max(FEW * k, ALONE * lists.n) if step < STEPS else np.ones(len(now), bool)
        for i, open_rows in zip(now[few].tolist(), own[few]):
            for row, score in read_alone(lists, ids, q[i], rows[open_rows], step, k, known[i]):
                yield i, row, score
        if own is not still:
            still[ready] = own
        stay = ~np.isin(waiting, now[few])
        waiting, still = waiting[stay], still[stay]
        kept = still.any(axis=0)
        if np.count_nonzero(kept) < 0.8 * len(kept):  # rows that are out for every query
            rows, still = rows[kept], still[:, kept]


def read_alone(
    lists: Lists, ids: np.ndarray, q: np.ndarray, rows: np.ndarray, step: int, k: int, known: np.int64
) -> list[tuple[int, int]]:
    """Go on reading for one query, with its open rows alone; (row id, score) of those that are resolved in the end."""
    reader = Reader(lists, q, rows)
    while len(reader.rows) > FEW * k and step < STEPS:
        step += 1
        low, high = reader.bounds(lists.depth(step))
        known = max(known, kth_best(low, k))
        reader.keep(high >= known)
    return resolved(lists, ids, q, reader.rows, k, step)


def resolved(lists: Lists, ids: np.ndarray, q: np.ndarray, rows: np.ndarray, k: int, step: int) -> list[tuple[int, int]]:
    """Final scores of the open rows, the k best."""
    scores = (lists.x[rows] @ q).astype(np.int64)
    order = np.lexsort((ids[rows], -scores))[:k]
    return list(zip(ids[rows][order].tolist(), scores[order].tolist()))


def with_known(queries: DataFrame, sample: list, k: int) -> DataFrame:
    """Blocks of queries with ``known``: for each query a score that k rows of the sample (id, v) reach."""
    dims = max((len(r["v"]) for r in sample), default=0)
    x = np.zeros((len(sample), dims), np.int64)
    for own, r in zip(x, sample):
        own[: len(r["v"])] = r["v"]
    ids = np.array([r["id"] for r in sample], np.int64)

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            found = []
            for row in batch.select(["dims", "ids", "values"]).to_pylist():
                n = min(dims, row["dims"])
                q = np.frombuffer(row["values"], np.int64).reshape(-1, row["dims"])[:, :n]
                kind = exact_type(x[:, :n], q) if len(x) else np.int64
                scores = (q.astype(kind) @ x[:, :n].T.astype(kind)).astype(np.float64 if kind is not np.int64 else np.int64)
                own = np.frombuffer(row["ids"], np.int64)[:, None] == ids[None, :]
                scores = np.where(own, NONE if kind is np.int64 else -np.inf, scores)
                found.append(kth_best(scores, k).astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "known"])

    return queries.mapInArrow(run, StructType([*queries.schema.fields, StructField("known", BinaryType())]))


def exact_type(x: np.ndarray, q: np.ndarray) -> type:
    """The fastest number type in which all sums of products are exact."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    return np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else np.int64


def search(
    vectors: DataFrame, *, every: int, k: int, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``k`` highest scores of each query: query_id, rank (from 1), vec_id, score.

    Vectors become floor(scale * x); queries are the rows whose id is divisible by ``every``, candidates all rows but those
    of the query's id. Score: inner product; ties go to the smaller id. Vectors that are null, empty or hold null or
    non-finite components, and rows without an id, take no part. A shorter vector counts as filled with zeros. Equal
    candidate rows are rows of their own; equal queries are one. Fewer rows than k: all. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), whole_numbers(F.col(vector_col), scale).alias("v"))
    rows = rows.where("id is not null and v is not null")
    row_blocks = packed(rows, BLOCK_ROWS, "row-blocks")
    query_blocks = packed(rows.where(F.col("id") % every == 0).distinct(), BLOCK_QUERIES, "query-blocks")
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 1
    sample = rows.orderBy(F.xxhash64("id"), "v").limit(max(k + 1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * longest)))).collect()
    query_blocks = with_known(query_blocks, sample, k)
    shelves = max(1, row_blocks.count())
    left = row_blocks.select((F.col("shelf") % shelves).alias("shelf"), "block", "dims", "ids", "values")
    right = query_blocks.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shelves - 1).cast("long"))).alias("shelf"),
        F.col("block").alias("q_block"), F.col("dims").alias("q_dims"), F.col("ids").alias("q_ids"), F.col("values").alias("q_values"), "known",
    )
    small_batches(spark)
    pairs = left.repartition(shelves, "shelf").join(right.repartition(shelves, "shelf"), "shelf").sortWithinPartitions("block")
    schema = pa.schema([(c, pa.int64()) for c in ("q_block", "q_row", "query_id", "vec_id", "score")])

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            kept: tuple = ()
            for batch in given:
                for row in batch.to_pylist():
                    dims = min(row["dims"], row["q_dims"])
                    x = np.frombuffer(row["values"], np.int64).reshape(-1, row["dims"])[:, :dims]
                    q = np.frombuffer(row["q_values"], np.int64).reshape(-1, row["q_dims"])[:, :dims]
                    ids, q_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
                    kind = exact_type(x, q)
                    if kept[:3] != (row["block"], dims, kind):
                        kept = (row["block"], dims, kind, Lists(x.astype(kind)))
                    known = np.frombuffer(row["known"], np.int64)
                    for i, vec_id, score in best(kept[3], ids, q.astype(kind), q_ids, k, known):
                        yield row["q_block"], i, int(q_ids[i]), vec_id, score

        yield from batches(found(), schema, max_rows=8192)

    near = pairs.select("block", "dims", "ids", "values", "q_block", "q_dims", "q_ids", "q_values", "known").mapInArrow(
        run, "q_block long, q_row long, query_id long, vec_id long, score long"
    )
    ranked = Window.partitionBy("q_block", "q_row").orderBy(F.desc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
