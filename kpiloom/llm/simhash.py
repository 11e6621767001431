"""SimHash fingerprints and near-duplicate groups by a range join on segment bit counts.

A fingerprint of 64 bits is cut into 32 segments of two bits; its embedding is the vector of the segments' bit counts
(0, 1 or 2). The Manhattan distance of two embeddings is never above the Hamming distance of the fingerprints. A distance
of at most 3 over all coordinates leaves at most 1 for one half of them, so fingerprints that link lie, in one half, in
the same cell of the grid or in cells that are neighbours along one axis. Each fingerprint is put into its cell in both
halves and into the next cell along each axis; what meets in a cell is held against the Manhattan bound and then verified
bit by bit. Copies are one fingerprint, and a cell reports links that span its groups, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from kpiloom.llm.common import as_rows, batches, named, small_batches, staged, worker_cache
from kpiloom.llm.graph import components

SEED = 42
#: Fingerprints of a cell compared by one task; a fuller cell is split into pairs of blocks.
CELL_ROWS = 2048
EVEN, ODD = np.uint64(0x5555555555555555), np.uint64(0xAAAAAAAAAAAAAAAA)


def shingle_hashes(text: str | None, shingle: int) -> list[int]:
    """Unsigned XXH64 of each run of ``shingle`` words; fewer words are one run, no words none."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < shingle:
        runs = [b" ".join(words)] if words else []
    else:
        runs = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    return list(map(xxhash.xxh64_intdigest, runs, repeat(SEED)))


def fingerprint(hashes: list[int]) -> int:
    """Bit i is set where more than half of the hashes have it; as a signed 64-bit integer. No hashes: zero."""
    if not hashes:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a bounded block of bits at a time
        raw = np.array(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, name: str, *, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with the signed fingerprint of ``text_col`` in the new last column ``name``."""
    small_batches(docs.sparkSession)
    k = docs.columns.index(text_col)

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            marks = [fingerprint(shingle_hashes(t, shingle)) for t in batch.column(k).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.int64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def embedding(bits: Column) -> Column:
    """Counts of 16 segments of two bits, each written in unary (00, 01, 11), of a half given as an integer."""
    some = (bits.bitwiseOR(F.shiftright(bits, 1))).bitwiseAND(F.lit(0x55555555))
    both = (bits.bitwiseAND(F.shiftright(bits, 1))).bitwiseAND(F.lit(0x55555555))
    return some.bitwiseOR(F.shiftleft(both, 1))


def cells(fingerprints: DataFrame) -> DataFrame:
    """Grid cells of each fingerprint ``fp``: cell, home (false for the next cell along an axis), fp."""
    halves = (F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32))
    rows = []
    for k, bits in enumerate(halves):
        at = embedding(bits)
        side = F.lit(k << 32)
        step = [
            F.when(at.bitwiseAND(F.lit(1 << 2 * s)) == 0, at.bitwiseOR(F.lit(1 << 2 * s))).when(
                at.bitwiseAND(F.lit(2 << 2 * s)) == 0, at.bitwiseOR(F.lit(2 << 2 * s))
            )
            for s in range(16)
        ]
        rows.append(F.struct((at + side).alias("cell"), F.lit(True).alias("home")))
        rows += [F.struct((x + side).alias("cell"), F.lit(False).alias("home")) for x in step]
    return fingerprints.select("fp", F.explode(F.array(*rows)).alias("c")).where("c.cell is not null").select("c.cell", "c.home", "fp")


def spanning_links(marks: np.ndarray, home: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links within ``bits`` that join what the links of a cell's own fingerprints join, fewer than there are marks.

    Groups grow breadth first from the cell's own; a fingerprint is compared only with those no group has reached yet, and
    a neighbour's (not ``home``) only with the cell's own: links among neighbours are found in their cells.
    """
    wide = marks.view(np.uint64)
    counts = ((wide | wide >> np.uint64(1)) & EVEN) | ((wide & wide << np.uint64(1)) & ODD)
    out = []

    def reached(k: int, left: np.ndarray) -> tuple[list[int], np.ndarray]:
        near = np.bitwise_count(counts[left] ^ counts[k]) <= bits  # Manhattan distance, a lower bound
        if near.any():
            near[near] = np.bitwise_count(wide[left[near]] ^ wide[k]) <= bits
        found = left[near].tolist()
        out.extend((int(marks[k]), int(marks[i])) for i in found)
        return found, left[~near] if found else left

    own, others = np.flatnonzero(home), np.flatnonzero(~home)
    while len(own):
        frontier, own = [int(own[0])], own[1:]
        while frontier:
            k = frontier.pop()
            found, own = reached(k, own)
            frontier += found
            if home[k]:
                found, others = reached(k, others)
                frontier += found
    return out


def links(fingerprints: DataFrame, bits: int = 3) -> DataFrame:
    """Links a, b between distinct fingerprints ``fp`` that keep every group within ``bits`` (3 or fewer) together."""
    if not 0 <= bits <= 3:
        raise ValueError("a neighbour along one axis proves distances of at most 3")
    spark = fingerprints.sparkSession
    small_batches(spark)
    placed = cells(fingerprints)
    crowded = placed.where("home").groupBy("cell").count().where(F.col("count") > CELL_ROWS)
    blocks = F.ceil(F.col("count") / CELL_ROWS).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(other, own) * F.col("blocks") + F.greatest(other, own),
    )
    dealt = (
        placed.join(crowded.select("cell", blocks.alias("blocks")), "cell", "left")
        .withColumn("block", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(pairs)))
        .select("cell", "block", "home", "fp")
        .repartition("cell", "block")
        .sortWithinPartitions("cell", "block")
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(cell: np.ndarray, home: np.ndarray, marks: np.ndarray) -> Iterator[tuple[int, int]]:
            """Links of whole cells; ``cell`` numbers the rows' cells in a row."""
            if not len(cell):
                return
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            sizes = np.diff(np.r_[starts, len(cell)])
            wanted = (sizes > 1) & (np.add.reduceat(home.astype(np.int64), starts) > 0)
            pair = starts[wanted & (sizes == 2)]  # most cells that hold more than one
            near = np.bitwise_count((marks[pair] ^ marks[pair + 1]).view(np.uint64)) <= bits
            yield from zip(marks[pair[near]].tolist(), marks[pair[near] + 1].tolist())
            for s, n in zip(starts[wanted & (sizes > 2)].tolist(), sizes[wanted & (sizes > 2)].tolist()):
                yield from spanning_links(marks[s : s + n], home[s : s + n], bits)

        def found() -> Iterator[tuple[int, int]]:
            held: list[tuple[np.ndarray, ...]] = []  # rows of the last cell, which the next batch may go on with
            for batch in given:
                cell, block, home, marks = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                if held and (cell[0], block[0]) == (held[0][0][0], held[0][1][0]) == (cell[-1], block[-1]):
                    held.append((cell, block, home, marks))
                    continue
                cell, block, home, marks = (np.concatenate(x) for x in zip(*held, (cell, block, home, marks)))
                number = np.cumsum(np.r_[0, (cell[1:] != cell[:-1]) | (block[1:] != block[:-1])])
                whole = int(np.searchsorted(number, number[-1]))
                yield from of(number[:whole], home[:whole], marks[:whole])
                held = [(cell[whole:], block[whole:], home[whole:], marks[whole:])]
            if held:
                cell, block, home, marks = (np.concatenate(x) for x in zip(*held))
                yield from of(np.zeros(len(cell), np.int64), home, marks)

        yield from batches(found(), schema, max_rows=8192)

    return dealt.mapInArrow(run, "a long, b long")


def groups(marked: DataFrame, bits: int = 3) -> DataFrame:
    """From rows (row_id, fp), a stored table: fp and component_id, the smallest row_id that links of ``bits`` reach."""
    nodes = staged(marked.groupBy("fp").agg(F.min("row_id").alias("first")), "fingerprints")
    reach = staged(components(links(nodes.select("fp"), bits)), "components")
    joined = nodes.join(reach, nodes["fp"] == reach["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    return joined.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Fingerprints link where at most ``bits`` (3 or fewer) bits differ; component_id is the smallest doc_id that links
    reach, itself included. Null, empty and blank texts have fingerprint zero and link like others. Rows without an id are
    never the smallest; a group of such rows alone has a null component. Repeated rows are in one group. An empty table
    gives no rows; other columns are not read.
    """
    rows = docs.select(named(id_col).alias("row_id"), named(text_col).alias("text"))
    marked = staged(with_fingerprint(rows, "fp", shingle=shingle).select("row_id", "fp"), "marked")
    found = groups(marked, bits)
    return marked.join(found, "fp").select(
        F.col("row_id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 3) -> DataFrame:
    """One row of each group of near duplicates (see ``near_duplicates``), that of the smallest id, with all its columns.

    Null, empty and blank texts are one group with whatever links to fingerprint zero. Rows without an id come last; of
    rows with equal ids, as of repeated rows, the first one read stays. All columns are kept as they are, whatever their
    names. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = as_rows(docs, row_id=F.monotonically_increasing_id(), id=named(id_col))
    k = docs.columns.index(text_col)

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("simhash")  # what other operators have kept here goes
        for batch in given:
            marks = [fingerprint(shingle_hashes(t, shingle)) for t in batch.column(0).field(k).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.int64())], ["row", "row_id", "id", "fp"])

    marked = staged(rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("fp", LongType())])), "marked")
    keyed = marked.select("row_id", "fp", "id")
    found = groups(keyed.select("row_id", "fp"), bits)
    best = F.min(F.struct(F.col("id").isNull(), "id", "row_id"))["row_id"]
    kept = keyed.join(found, "fp").groupBy("component_id").agg(best.alias("row_id"))
    return marked.join(kept, "row_id", "left_semi").select("row.*")
