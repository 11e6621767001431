"""Quality rules on whole texts: repetition by a suffix array over words, with plain counts beside it.

A repeat is a run of words that occurs at two places of one text. In a suffix array (the places of a text, sorted by what
follows them) neighbours share the longest runs, so the longest common prefixes of neighbours give every maximal repeat.
A text without two equal runs of ``window`` words needs no array; equal runs of 1, 2, 4 ... words are looked for among
the places that are left, over a whole batch of texts at once.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kpiloom.llm.common import as_rows, named, small_batches, worker_cache

SPACE = b"\t\n\x0b\x0c\r "
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat")

#: Limits. A text fails the base rules with fewer words, or with a larger share of its words in repeats; the method also
#: rejects one whose longest single repeat is a larger share of its words. A passage that stands twice covers twice its
#: length, so this limit decides by itself between a tenth and three twentieths of the words.
MIN_WORDS = 20
MAX_COVERED_PERCENT = 30
MAX_LONGEST_PERCENT = 10
#: Words put into one suffix array; texts are added whole, so only a longer text makes a larger array.
ARRAY_WORDS = 200_000


def word_codes(words: list[bytes]) -> list[int]:
    """For each word the place of its first occurrence."""
    return list(map({}.setdefault, words, count()))


def repeats_somewhere(codes: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """Numbers of the texts (``owner`` by place) that hold two equal runs of ``window`` words; window: a power of two."""
    at = np.arange(len(codes))
    rank, h = codes.astype(np.int64), 1
    while True:
        n_equal = np.bincount(rank[at], minlength=1)
        at = at[n_equal[rank[at]] > 1]
        if h == window or not len(at):
            return np.unique(owner[at])
        alive = np.zeros(len(codes) + h, bool)
        alive[at] = True
        at = at[alive[at + h]]
        at = at[owner[at] == owner[np.minimum(at + h, len(codes) - 1)]]
        _, inverse = np.unique(rank[at] * np.int64(len(codes) + 1) + rank[at + h], return_inverse=True)
        rank = np.zeros(len(codes), np.int64)
        rank[at] = inverse
        h *= 2


def dense(keys: np.ndarray) -> np.ndarray:
    """Each key's place among the distinct keys."""
    order = np.argsort(keys)
    keys = keys[order]
    place = np.cumsum(np.r_[False, keys[1:] != keys[:-1]][: len(keys)], dtype=np.int32)
    out = np.empty(len(keys), np.int32)
    out[order] = place
    return out


def neighbour_prefixes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by prefix doubling, and the longest common prefix of each suffix with the one before it.

    The prefixes come from the ranks of all doubling steps; an array of more than ``ARRAY_WORDS`` words, one long text,
    keeps no ranks and walks along the text instead.
    """
    n = len(codes)
    rank = dense(codes.astype(np.int64))
    ranks, h = [rank], 1
    while rank.max(initial=0) + 1 < n:
        keys = rank.astype(np.int64)
        keys *= n + 1
        keys[: n - h] += rank[h:]
        keys[: n - h] += 1
        rank = dense(keys)
        if n <= ARRAY_WORDS:
            ranks.append(rank)
        h *= 2
    keys = None
    order = np.empty(n, np.int32)
    order[rank] = np.arange(n, dtype=np.int32)
    if n > ARRAY_WORDS:
        return order, walked_prefixes(codes, order, rank)
    left, right = order[:-1].astype(np.int64), order[1:].astype(np.int64)
    common = np.zeros(n, np.int64)
    for k in range(len(ranks) - 2, -1, -1):
        inside = (left < n) & (right < n)
        same = np.zeros(n - 1, bool)
        same[inside] = ranks[k][left[inside]] == ranks[k][right[inside]]
        common[1:] += same << k
        left, right = left + (same << k), right + (same << k)
    return order, common


def walked_prefixes(codes: np.ndarray, order: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Common prefixes of neighbours in one walk along the text: the next place's prefix is one word shorter at most."""
    n = len(codes)
    text, before = (array("i", x.astype(np.int32).tobytes()) for x in (codes, np.r_[np.int32(-1), order[:-1]][place]))
    lengths, h = array("i", bytes(4 * n)), 0
    for i in range(n):
        j = before[i]
        if j < 0:
            h = 0
            continue
        while i + h < n and j + h < n and text[i + h] == text[j + h]:
            h += 1
        lengths[i] = h
        h = max(h - 1, 0)
    return np.frombuffer(lengths, np.int32)[order]


def repeat_measures(codes: np.ndarray, sizes: list[int], window: int) -> list[tuple[int, int]]:
    """For texts whose codes stand in a row: words inside repeats of ``window`` words or more, and the longest repeat."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # a word of its own after each text, so that no run goes from one text into the next
    spaced = np.insert(codes, ends, codes.max(initial=0) + 1 + np.arange(len(sizes)))
    order, common = neighbour_prefixes(spaced)
    longest = np.zeros(len(spaced), np.int64)
    np.maximum.at(longest, order, common)
    np.maximum.at(longest, order[:-1], common[1:])
    longest[longest < window] = 0
    edge = np.zeros(len(spaced) + 1, np.int64)
    places = np.flatnonzero(longest)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + longest[places], -1)
    covered = np.cumsum(edge[:-1]) > 0
    out = []
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        cut = slice(a + i, b + i)
        out.append((int(covered[cut].sum()), int(longest[cut].max(initial=0))))
    return out


def counts_of(texts: list[str | None], window: int = 8) -> list[tuple[int, ...]]:
    """``COUNTS`` of each text."""
    rows, codes, sizes = [], [], []
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.split()
        lines = [x for x in raw.split(b"\n") if x.strip()] if b"\n" in raw else []
        spaces = len(raw) - len(raw.translate(None, SPACE))
        symbols = len(raw) - len(raw.translate(None, SYMBOLS))
        rows.append((len(words), len(text or "") - spaces, symbols, len(lines) - len(set(lines))))
        codes.append(np.array(word_codes(words), np.int64))
        sizes.append(len(words))
        del words, lines  # as objects they take many times the text
    flat = np.concatenate([c + a for c, a in zip(codes, np.cumsum([0, *sizes]).tolist())] or [np.zeros(0, np.int64)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    found = dict.fromkeys(range(len(sizes)), (0, 0))
    ends = np.cumsum(sizes) if sizes else np.zeros(0, int)
    group: list[int] = []

    def measure() -> None:
        together = np.concatenate([flat[ends[i] - sizes[i] : ends[i]] for i in group])
        found.update(zip(group, repeat_measures(together, [sizes[i] for i in group], window)))

    for i in repeats_somewhere(flat, owner, window).tolist() if len(flat) else []:
        if group and sum(sizes[k] for k in group) + sizes[i] > ARRAY_WORDS:
            measure()
            group = []
        group.append(i)
    if group:
        measure()
    return [(*row, *found[i]) for i, row in enumerate(rows)]


def verdict(n_words: int, n_repeat_words: int, longest_repeat: int) -> tuple[bool, bool]:
    """(base_failed, kept)."""
    failed = n_words < MIN_WORDS or 100 * n_repeat_words > MAX_COVERED_PERCENT * n_words
    return failed, not failed and 100 * longest_repeat <= MAX_LONGEST_PERCENT * n_words


def verdicts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 8) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row.

    Counts: words, code points in words, symbols, lines equal to an earlier line, words in repeats of ``window`` (a power
    of two) words or more, words of the longest repeat. A null text is empty and, like every text under 20 words, fails.
    Null ids and repeated rows are rows like others; an empty table gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(named(id_col).alias("doc_id"), named(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    names = ["doc_id", *COUNTS, "base_failed", "kept"]
    types = [to_arrow_type(id_type), *[pa.int64()] * len(COUNTS), pa.bool_(), pa.bool_()]

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            counted = [(*c, *verdict(c[0], c[4], c[5])) for c in counts_of(batch.column(1).to_pylist(), window)]
            columns = [pa.array([r[k] for r in counted], types[k + 1]) for k in range(len(names) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    kinds = ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, {kinds}, base_failed boolean, kept boolean")


def keep(docs: DataFrame, *, text_col: str = "text", window: int = 8) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns as they are, whatever their names.

    A null, empty or blank text goes, as it has fewer words than the least. Ids are not looked at, so null and repeated ids
    and repeated rows are judged like others. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = as_rows(docs)
    k = docs.columns.index(text_col)

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("quality")  # what other operators have kept here goes
        for batch in given:
            good = [verdict(c[0], c[4], c[5])[1] for c in counts_of(batch.column(0).field(k).to_pylist(), window)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return rows.mapInArrow(run, rows.schema).select("row.*")
