"""Removal of long strings that occur before, by interval expansion on a Burrows-Wheeler transform.

Which strings can meet is settled first. Every string of ``length`` bytes is keyed by the gram with the smallest hash in it
(leftmost of equals), so equal strings have equal keys, and the strings of a text that share a gram form a piece: a stretch
of the text. Pieces are dealt by key. Equal pieces are counted as one, the first; all others are repeats throughout. A key
with one piece needs nothing more. The different pieces of a key go, with those of other keys, into a block of text.

In a block the transform groups equal strings. Suffixes stand sorted; a boundary between neighbours appears at the length
at which they first differ. Boundaries are found breadth first, by length: a string of length l + 1 is a character put
before a string of length l, so a boundary between two of them is a boundary of length l between what follows. At
``length`` the expansion stops: suffixes with no boundary between them share at least so many bytes.

Hot keys are split twice: a key with very many occurrences (found in a fraction of the texts; this only steers the
layout) is dealt by key and text, and each share finds its own first pieces; a key with too many different pieces for one
block is refined, its strings keyed anew by all bytes that a half of them have in common, until no key is too full. In a
refined key equal pieces are reduced to the first one before they are shuffled, so a passage that very many texts share
never meets in one task. Nothing is capped. Pieces are equal if their key and 128 bits of their digest are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, ShortType

from kpiloom.llm.common import batches, small_batches, staged

#: Bytes of a block, and different pieces of one key that go into one block.
BLOCK_BYTES = 1 << 18
GROUP_PIECES = 1024
#: Occurrences of a key that one task gets, and the share of texts (1 in ...) they are estimated from.
HEAVY_ROWS, HEAVY_SAMPLE = 200_000, 64
#: Bytes of text hashed at once; a longer text is read in stretches that overlap.
STRETCH = 1 << 20
PLACE_BITS = np.uint64(22)

PIECES = "key long, digest long, digest2 long, row long, at int, starts short, ahead short, known boolean"
FOUND = "candidate boolean, key long, row long, at int, starts short, ahead short"


def gram_size(length: int) -> int:
    """The largest power of two that is at most a third of ``length``."""
    return 1 << max(0, (length // 3).bit_length() - 1)


def gram_hashes(text: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` (a power of two) bytes from each place of a byte array."""
    h, factor, width = text.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    while width < size:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = factor * factor % (1 << 64)
        width *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, reach = values, 1
    while 2 * reach <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def pieces_of(stretch: bytes, sizes: list[int], length: int) -> tuple[np.ndarray, ...]:
    """Pieces of texts of ``sizes`` bytes that stand in a row: text, at (in the text), starts, place of the gram, key."""
    text = np.frombuffer(stretch, np.uint8)
    if len(text) < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    gram = gram_size(length)
    hashes = gram_hashes(text, gram)
    mask = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    least = sliding_min((hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    starts = np.flatnonzero(owner[: len(text) - length + 1] == owner[length - 1 :])
    gram_at = (least[starts] & mask).astype(np.int64)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    new = np.flatnonzero(np.r_[True, (gram_at[1:] != gram_at[:-1]) | (starts[1:] != starts[:-1] + 1)])
    at, n = starts[new], np.diff(np.r_[new, len(starts)])
    return owner[at], at - first[owner[at]], n, gram_at[new] - at, hashes[gram_at[new]]


def stretches(rows: list[int], texts: list[bytes], length: int) -> Iterator[tuple[list[tuple[int, int]], bytes, list[int]]]:
    """Texts put together, or parts of long ones: (row, offset of the part), the bytes, the sizes."""
    marks, parts, held = [], [], 0
    for row, text in zip(rows, texts):
        for offset in range(0, max(1, len(text)), STRETCH):
            part = text[offset : offset + STRETCH + length - 1]
            if held and held + len(part) > STRETCH:
                yield marks, b"".join(parts), [len(p) for p in parts]
                marks, parts, held = [], [], 0
            marks.append((row, offset))
            parts.append(part)
            held += len(part)
    if held:
        yield marks, b"".join(parts), [len(p) for p in parts]


def keyed_pieces(texts: DataFrame, length: int, digests: bool = True) -> DataFrame:
    """All pieces of ``texts`` (row, text): ``PIECES``; digest is 0 where it is not asked for.

    Of equal pieces in a stretch of text all but the first are known to be repeats: they get a key of their own, so that
    what occurs very often is not dealt to one task.
    """
    names = [f.split()[0] for f in PIECES.split(", ")]

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in given:
            raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            for marks, stretch, sizes in stretches(batch.column(0).to_pylist(), raw, length):
                owner, at, n, ahead, keys = pieces_of(stretch, sizes, length)
                if not len(at):
                    continue
                row, offset = (np.array(x, np.int64)[owner] for x in zip(*marks))
                digest = np.zeros((len(at), 2), np.uint64)
                if digests:
                    left = at + (np.cumsum(sizes) - sizes)[owner]
                    right = left + n + length - 1
                    view = memoryview(stretch)
                    raws = b"".join([xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(left.tolist(), right.tolist())])
                    digest = np.frombuffer(raws, np.uint64).reshape(-1, 2)
                at = at + offset
                known = np.zeros(len(at), bool)
                if digests:
                    order = np.lexsort((at, row, digest[:, 1], digest[:, 0], keys))
                    same = (keys[order[1:]] == keys[order[:-1]]) & (digest[order[1:]] == digest[order[:-1]]).all(axis=1)
                    known[order[1:]] = same
                    keys, digest = np.where(known, row.view(np.uint64), keys), np.where(known[:, None], np.uint64(0), digest)
                halves = [np.ascontiguousarray(digest[:, k]).view(np.int64) for k in (0, 1)]
                columns = [keys.view(np.int64), *halves, row, at.astype(np.int32), n.astype(np.int16), ahead.astype(np.int16), known]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return texts.mapInArrow(run, PIECES)


def heavy_keys(texts: DataFrame, length: int) -> DataFrame:
    """Keys that are likely to occur more than ``HEAVY_ROWS`` times, from a fraction of the texts, and the shares for each."""
    some = texts.where(F.pmod(F.xxhash64("row"), F.lit(HEAVY_SAMPLE)) == 0)
    counts = keyed_pieces(some, length, digests=False).groupBy("key").count()
    likely = F.col("count") * HEAVY_SAMPLE
    return staged(counts.where(likely > HEAVY_ROWS).select("key", F.ceil(likely / HEAVY_ROWS).alias("shares")), "heavy-keys")


def first_and_others(pieces: DataFrame) -> DataFrame:
    """From pieces with a ``part`` (0, the share of a heavy key, or -1: known as a repeat): ``FOUND``.

    A row is a repeat of an equal piece before it (candidate false) or the first of its kind in a key with pieces of
    several kinds (candidate true). First pieces that are alone in their key are left out. In a share of a heavy key the
    first of each kind in the share is a candidate; the next steps find out which of them repeat those of other shares.
    """
    names = ["key", "part", "digest", "digest2", "row", "at", "starts", "ahead"]
    dealt = pieces.select(*names).repartition("key", "part").sortWithinPartitions("key", "part", "digest", "digest2", "row", "at")

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch, chosen: np.ndarray, candidate: bool) -> pa.RecordBatch:
            took = batch.take(pa.array(chosen))
            columns = [pa.array(np.full(len(chosen), candidate)), *(took.column(c) for c in ("key", "row", "at", "starts", "ahead"))]
            labels = ["candidate", "key", "row", "at", "starts", "ahead"]
            return pa.RecordBatch.from_arrays(columns, labels)

        last, alone = (None,) * 4, None  # the last row's group and digest; its group's only first piece so far
        several = False  # whether the last group has shown pieces of several kinds
        for batch in given:
            key, part, digest, digest2 = (batch.column(k).to_numpy() for k in range(4))
            new_group = np.r_[(key[0], part[0]) != last[:2], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]
            new_kind = new_group | np.r_[digest[0] != last[2], digest[1:] != digest[:-1]]
            new_kind |= np.r_[digest2[0] != last[3], digest2[1:] != digest2[:-1]]
            known = part < 0
            others = np.flatnonzero(~new_kind | known)
            if len(others):
                yield rows(batch, others, False)
            leaders = np.flatnonzero(new_kind & ~known)
            group = np.cumsum(new_group)  # 0: the group that the batch before ended with
            n_kinds = np.bincount(group[leaders], minlength=int(group[-1]) + 1)
            heavy = part > 0
            if n_kinds[0] and not several:
                several = True
                if alone is not None:
                    yield rows(alone, np.zeros(1, np.int64), True)
                    alone = None
            many = n_kinds > 1
            many[0] |= several
            good = leaders[many[group[leaders]] | heavy[leaders]]
            if len(good):
                yield rows(batch, good, True)
            if group[-1] > 0:  # the last group began in this batch
                several = bool(many[-1] or heavy[-1] or known[-1])
                alone = None if several else batch.slice(int(leaders[group[leaders] == group[-1]][0]), 1)
            last = (key[-1], part[-1], digest[-1], digest2[-1])

    return dealt.mapInArrow(run, FOUND)


def first_and_others_of_hot(pieces: DataFrame) -> DataFrame:
    """As ``first_and_others``, for stored pieces of refined keys, with their bytes; any key may be very frequent.

    The first of each kind is a minimum, made before the shuffle; the other pieces find by their own place, not by their
    key, that they are not the first.
    """
    identity = ["key", "row", "at", "starts"]
    kinds = pieces.groupBy("key", "digest", "digest2").agg(F.min(F.struct(*identity[1:])).alias("first"))
    kinds = staged(kinds.select("key", "first.*"), "first-pieces")
    several = kinds.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    candidates = kinds.join(several, "key").withColumn("kept", F.lit(True))
    marked = pieces.join(kinds.withColumn("candidate", F.lit(True)), identity, "left").join(candidates, identity, "left")
    chosen = marked.where("kept or candidate is null")
    return chosen.select(F.coalesce("candidate", F.lit(False)).alias("candidate"), "key", "row", "at", "starts", "ahead", "bytes")


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` (bytes, ending with a unique smallest one) by what follows them, to ``depth`` bytes or more."""
    n = len(text)
    wide = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | wide[k : k + n]
    reach = 8
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[False, ranked[1:] != ranked[:-1]])
        if reach >= depth or rank[order[-1]] == n - 1:
            return order
        key = rank * np.int64(n + 1)
        key[: n - reach] += rank[reach:] + 1
        reach *= 2


def equal_strings(text: np.ndarray, length: int) -> np.ndarray:
    """For each place of ``text`` the number of its group: places whose next ``length`` bytes are equal share one.

    The interval expansion: from the transform follows where the suffix after a row's first byte stands (``after``). Rows
    with unequal first bytes have a boundary of length 1. A row without a boundary gets one of length l + 1 when one of
    length l lies between the rows that follow it and its neighbour.
    """
    text = np.r_[text + np.uint8(1), np.uint8(0)]  # bytes of UTF-8 stay below 255
    order = suffix_order(text, length)
    transform = text[order - 1]
    after = np.argsort(transform, kind="stable").astype(np.int32)
    first = transform[after]
    boundary = np.r_[True, first[1:] != first[:-1]]
    rows = np.flatnonzero(~boundary).astype(np.int32)
    high, low = after[rows], after[rows - 1]
    for _ in range(1, length):
        before = np.cumsum(boundary, dtype=np.int32)
        split = before[high] != before[low]
        boundary[rows[split]] = True
        rows, high, low = rows[~split], high[~split], low[~split]
        if not len(rows):
            break
    group = np.empty(len(text), np.int64)
    group[order] = np.cumsum(boundary)
    return group[:-1]


def repeats_in_block(rows: np.ndarray, ats: np.ndarray, starts: np.ndarray, texts: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """Spans (row, start, end) of the strings of a block of pieces that also start earlier in one of its pieces."""
    group = equal_strings(np.frombuffer(b"".join(texts), np.uint8), length)
    sizes = starts + length - 1
    first = np.cumsum(sizes) - sizes
    piece = np.repeat(np.arange(len(starts)), starts)
    inside = np.arange(len(piece)) - np.repeat(np.cumsum(starts) - starts, starts)
    group = group[first[piece] + inside]
    row, start = rows[piece], ats[piece] + inside
    order = np.lexsort((start, row, group))
    again = np.zeros(len(piece), bool)
    again[order[1:]] = group[order[1:]] == group[order[:-1]]
    found = np.flatnonzero(again)
    if not len(found):
        return
    run = np.flatnonzero(np.r_[True, (found[1:] != found[:-1] + 1) | (piece[found[1:]] != piece[found[:-1]])])
    ends = np.r_[run[1:], len(found)] - 1
    yield from zip(row[found[run]].tolist(), start[found[run]].tolist(), (start[found[ends]] + length).tolist())


def spans_by_transform(candidates: DataFrame, length: int) -> DataFrame:
    """Spans (row, start, end) of repeats among candidate pieces (key, row, at, starts, bytes), whole keys to a block."""
    dealt = candidates.select("key", "row", "at", "starts", "bytes").repartition("key").sortWithinPartitions("key")
    schema = pa.schema([("row", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans() -> Iterator[tuple]:
            rows, ats, starts, texts, held, last = [], [], [], [], 0, None
            for batch in given:
                for key, row, at, n, raw in zip(*(c.to_pylist() for c in batch.columns)):
                    if held >= BLOCK_BYTES and key != last:
                        yield from repeats_in_block(np.array(rows), np.array(ats), np.array(starts), texts, length)
                        rows, ats, starts, texts, held = [], [], [], [], 0
                    rows.append(row)
                    ats.append(at)
                    starts.append(n)
                    texts.append(raw)
                    held += len(raw)
                    last = key
            if texts:
                yield from repeats_in_block(np.array(rows), np.array(ats), np.array(starts), texts, length)

        yield from batches(spans(), schema, max_rows=8192)

    return dealt.mapInArrow(run, "row long, start int, end int")


def refined(pieces: DataFrame, length: int, low: list[int]) -> DataFrame:
    """Pieces keyed anew. ``low``: the least distances from a string's start to its gram in each range, ascending.

    The strings of a piece whose distance lies in a range share a stretch of bytes; with the key it is their new key.
    """
    bounds = list(zip(low, [x - 1 for x in low[1:]] + [length]))
    names = ["key", "digest", "digest2", "row", "at", "starts", "ahead", "known", "bytes"]

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def made() -> Iterator[tuple]:
            for batch in given:
                for key, row, at, n, ahead, raw in zip(*(c.to_pylist() for c in batch.columns)):
                    for a, b in bounds:
                        b = min(b, length - gram_size(length))
                        i, j = max(0, ahead - b), min(n - 1, ahead - a)  # starts whose distance is from a to b
                        if i > j:
                            continue
                        common = raw[ahead - a : ahead - b + length]
                        seed = (key ^ a * 0x9E3779B97F4A7C15) % (1 << 64)
                        own = raw[i : j + length]
                        wide = xxhash.xxh3_128_intdigest(own)
                        keys = (xxhash.xxh64_intdigest(common, seed), wide >> 64, wide % (1 << 64))
                        yield *(k - (1 << 64) if k >> 63 else k for k in keys), row, at + i, j - i + 1, ahead - i, False, own

        schema = pa.schema(list(zip(names, [pa.int64()] * 4 + [pa.int32(), pa.int16(), pa.int16(), pa.bool_(), pa.binary()])))
        yield from batches(made(), schema, max_rows=8192)

    return pieces.select("key", "row", "at", "starts", "ahead", "bytes").mapInArrow(run, PIECES + ", bytes binary")


def squeezed(texts: DataFrame) -> DataFrame:
    """row and the text's bytes, compressed for the shuffles."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)
        for batch in given:
            raw = [pack.compress(b"" if t is None else t.encode("utf-8", "surrogatepass")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["row", "packed"])

    return texts.mapInArrow(run, "row long, packed binary")


def with_bytes(found: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """Candidate pieces with the bytes they stand for; texts come by their row, a text's pieces together."""
    wanted = found.groupBy("row").agg(F.collect_list(F.struct("key", "at", "starts", "ahead")).alias("pieces"))
    joined = squeezed(texts).join(wanted, "row").select("row", "packed", "pieces")
    schema = pa.schema(
        [("key", pa.int64()), ("row", pa.int64()), ("at", pa.int32()), ("starts", pa.int16()), ("ahead", pa.int16()), ("bytes", pa.binary())]
    )

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()

        def cut() -> Iterator[tuple]:
            for batch in given:
                lists = batch.column(2)
                ends = lists.offsets.to_numpy()
                keys, ats, counts, aheads = (x.to_pylist() for x in lists.values.flatten())
                for i, (row, packed) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                    raw = unpack.decompress(packed.as_buffer())
                    for k in range(ends[i], ends[i + 1]):
                        yield keys[k], row, ats[k], counts[k], aheads[k], raw[ats[k] : ats[k] + counts[k] + length - 1]

        yield from batches(cut(), schema, max_rows=8192)

    return joined.mapInArrow(run, "key long, row long, at int, starts short, ahead short, bytes binary")


def repeated_spans(texts: DataFrame, length: int) -> DataFrame:
    """Spans (row, start, end) that cover every string of ``length`` bytes of ``texts`` (row, text) that starts earlier too.

    Earlier: in a text of a smaller row, or before in the same text.
    """
    pieces = keyed_pieces(texts, length)
    heavy = heavy_keys(texts, length)
    part = F.when(F.col("known"), -1)
    if heavy.count():
        pieces = pieces.join(heavy, "key", "left")
        part = part.when(F.col("shares").isNotNull(), 1 + F.pmod(F.xxhash64("row"), "shares"))
    pieces = pieces.withColumn("part", part.otherwise(0).cast("int"))
    found = staged(first_and_others(pieces), "pieces")
    spans = [whole_spans(found, length)]
    candidates = staged(with_bytes(found.where("candidate"), texts, length), "candidates")
    ranges = [0]
    while True:
        full = candidates.groupBy("key").count().where(F.col("count") > GROUP_PIECES).select("key")
        full = staged(full, "full-keys")
        if not full.count():
            spans.append(staged(spans_by_transform(candidates, length), "spans"))
            break
        spans.append(staged(spans_by_transform(candidates.join(full, "key", "left_anti"), length), "spans"))
        most = length - gram_size(length)
        ranges = sorted({*ranges, *((a + b) // 2 for a, b in zip(ranges, [*ranges[1:], most + 1]))})
        again = staged(refined(candidates.join(full, "key"), length, ranges).drop("known"), "refined")
        found = staged(first_and_others_of_hot(again), "pieces")
        spans.append(whole_spans(found, length))
        candidates = found.where("candidate").drop("candidate")
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def whole_spans(found: DataFrame, length: int) -> DataFrame:
    """Spans of the pieces that repeat an equal one."""
    return found.where("not candidate").select("row", F.col("at").alias("start"), (F.col("at") + F.col("starts") + (length - 1)).alias("end"))


def numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """row, doc_id, text: rows numbered in the order of their ids, null last, equal ids by the text's hash; and whether
    the ids are the numbers.

    Whole-number ids that are unique and never null number the rows themselves. Else the rows are sorted and stored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if isinstance(rows.schema["doc_id"].dataType, (LongType, IntegerType, ShortType)):
        n, n_ids, n_kinds = rows.agg(F.count("*"), F.count("doc_id"), F.countDistinct("doc_id")).first()
        if n == n_ids == n_kinds:
            return rows.select(F.col("doc_id").cast("long").alias("row"), "doc_id", "text"), True
    keyed = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(ordered.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "numbered"), False


def remove_repeats(docs: DataFrame, *, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each byte covered by a string of ``length`` bytes that also starts earlier; a row per row of ``docs``.

    Texts are UTF-8 bytes, matches stay inside a text, overlaps count, strings are judged on the texts as given. Earlier is
    a smaller id, or the same text before. Returns doc_id, n_bytes, spans (array of start, end: the removed runs), kept
    (bytes). A null text is empty. Rows of equal id are ordered by a hash of their text, rows without an id come last;
    each is a document of its own. An empty table gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows, own_numbers = numbered(docs, id_col, text_col)
    texts = rows.select("row", "text")
    spans = repeated_spans(texts, length)
    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = squeezed(texts).join(by_row, "row", "left").select("row", "packed", "spans")
    out = "row long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in given:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy()
            starts, ends = (x.to_numpy(zero_copy_only=False) for x in lists.values.flatten())
            sizes, runs, kept = [], [], []
            for i, packed in enumerate(batch.column(1)):
                raw = unpack.decompress(packed.as_buffer())
                own = merged(starts[offsets[i] : offsets[i + 1]], ends[offsets[i] : offsets[i + 1]])
                cuts = [0, *(x for s in own for x in s), len(raw)]
                sizes.append(len(raw))
                runs.append([{"start": a, "end": b} for a, b in own])
                kept.append(b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2])) if own else raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, span), pa.array(kept, pa.binary())],
                ["row", "n_bytes", "spans", "kept"],
            )

    done = joined.mapInArrow(run, out)
    if own_numbers:
        return done.select(F.col("row").cast(rows.schema["doc_id"].dataType).alias("doc_id"), "n_bytes", "spans", "kept")
    return done.join(rows.select("row", "doc_id"), "row").select("doc_id", "n_bytes", "spans", "kept")


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of a union of spans."""
    if not len(starts):
        return []
    order = np.argsort(starts)
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    return list(zip(starts[new].tolist(), reach[np.r_[new[1:] - 1, len(starts) - 1]].tolist()))
