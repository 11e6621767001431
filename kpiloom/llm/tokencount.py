"""Token counts of whole texts by byte-pair merging, without ids.

A text is cut at the strings of added tokens (one token each), the rest into words as byte-level vocabularies have them. A
word starts as its bytes, a linked list of symbols. A heap holds the ranks of the pairs that stand in the list, each with
its places; the lowest rank is popped and its places merged from left to right. What is left is counted: the bytes less the
merges. Equal words are counted once per worker, as long as its store of words holds them.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import small_batches, worker_cache
from kpiloom.llm.tokens import byte_letters

#: Words of at most 48 letters kept by one worker, in each of two generations.
KEPT_WORDS = 400_000
#: Characters of a slice of text that is cut into words at once.
SLICE = 1 << 20
# Fixed value: how byte-level vocabularies cut a text into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Letters whose kind is the same in all versions of Unicode in use; a text with others is cut by the tokenizers library.
OTHER = re.compile("[^\0-\u0557\u05d0-\u05ea\u2010-\u2064\u20a0-\u20bf\u2190-\u23ff\u2500-\u2bff\u3000-\u3096\u4e00-\u9fa5\uac00-\ud7a3\uff00-\uff5e\U0001f300-\U0001f64f]")
#: No word goes past this place: a letter, a space and a letter.
CUT = re.compile(r"[A-Za-z0-9.,;:](?= [A-Za-z])")


class Merges(dict):
    """Number of tokens by word, filled as words are met."""

    def __init__(self, path: str) -> None:
        from tokenizers import pre_tokenizers

        super().__init__()
        self.older: dict[str, int] = {}
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or cut != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError(f"{path} is no byte-level byte-pair vocabulary")
        if spec["normalizer"] or model["ignore_merges"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has settings that are not counted here")
        symbols = {letter: byte for byte, letter in byte_letters().items()}  # bytes, then one symbol per rank
        self.ranks: dict[int, int] = {}  # by the two symbols in one number
        self.pairs: list[tuple[int, int]] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            if left not in symbols or right not in symbols:
                raise ValueError(f"{path}: {left} {right} is merged before its parts are made")
            self.pairs.append((symbols[left], symbols[right]))
            self.ranks.setdefault(symbols[left] << 32 | symbols[right], rank)
            symbols.setdefault(left + right, 256 + rank)
        self.made = [symbols["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False)

    def tokens(self, word: bytes) -> int:
        """Symbols left of ``word`` when no pair can be merged any more."""
        return self.of_short(word) if len(word) < 256 else self.of_long(word)

    def of_short(self, word: bytes) -> int:
        """The heap holds rank and place of every pair in one number."""
        n, rank_of, made = len(word), self.ranks.get, self.made
        symbols, left, right = list(word), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [r << 8 | i for i, r in enumerate(map(rank_of, [a << 32 | b for a, b in pairwise(word)])) if r is not None]
        heapify(heap)
        merges = 0
        while heap:
            top = heappop(heap)
            rank, i = top >> 8, top & 255
            j = right[i]
            if j >= n or rank_of(symbols[i] << 32 | symbols[j]) != rank:
                continue  # merged meanwhile
            symbols[i] = new = made[rank]
            symbols[j] = -1
            merges += 1
            right[i] = after = right[j]
            before = left[i]
            if after < n:
                left[after] = i
                if (r := rank_of(new << 32 | symbols[after])) is not None:
                    heappush(heap, r << 8 | i)
            if before >= 0 and (r := rank_of(symbols[before] << 32 | new)) is not None:
                heappush(heap, r << 8 | before)
        return n - merges

    def of_long(self, word: bytes) -> int:
        """The heap holds ranks, each with the places of its pairs: some 30 bytes of memory for each byte of the word."""
        n = len(word)
        ranks, symbols = self.ranks, array("i", iter(word))
        left, right = array("i", range(-1, n - 1)), array("i", range(1, n + 1))
        places: dict[int, array] = {}
        for i in range(n - 1):
            rank = ranks.get(symbols[i] << 32 | symbols[i + 1])
            if rank is not None:
                places.setdefault(rank, array("i")).append(i)
        heap = list(places)
        heapify(heap)
        merges = 0
        while heap:
            rank = heappop(heap)
            (first, second), made = self.pairs[rank], self.made[rank]
            for i in ascending(places.pop(rank)):
                j = right[i]
                if symbols[i] != first or j >= n or symbols[j] != second:
                    continue  # merged meanwhile
                symbols[i], symbols[j] = made, -1
                merges += 1
                after, before = right[j], left[i]
                right[i] = after
                if after < n:
                    left[after] = i
                    self.note(made, symbols[after], i, places, heap)
                if before >= 0:
                    self.note(symbols[before], made, before, places, heap)
        return n - merges

    def note(self, first: int, second: int, place: int, places: dict[int, array], heap: list[int]) -> None:
        rank = self.ranks.get(first << 32 | second)
        if rank is not None:
            if rank not in places:
                places[rank] = array("i")
                heappush(heap, rank)
            places[rank].append(place)

    def __missing__(self, word: str) -> int:
        n = self.older.pop(word, None)
        if n is None:
            n = self.tokens(word.encode())
        if len(word) <= 48:
            if len(self) >= KEPT_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = n
        return n

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; those of none: 0."""
        if not text:
            return 0
        if self.added and self.added.search(text):
            parts = self.added.split(text)
            return len(parts) - 1 + sum(map(self.count, parts))
        return sum(map(self.of_slice, slices(text)))

    def of_slice(self, text: str) -> int:
        if OTHER.search(text):
            return sum(self[text[i:j]] for _, (i, j) in self.library.pre_tokenize_str(text))
        if len(text) <= 4 * SLICE:
            return sum(map(self.__getitem__, WORDS.findall(text)))
        return sum(self[m.group()] for m in WORDS.finditer(text))  # no place to cut was found: one word at a time


def ascending(places: array) -> Iterator[int]:
    if len(places) < 4096:
        yield from sorted(places)
        return
    ordered = np.sort(np.frombuffer(places, np.int32))
    for at in range(0, len(ordered), 4096):
        yield from ordered[at : at + 4096].tolist()


def slices(text: str) -> Iterator[str]:
    """The text in pieces of about ``SLICE`` characters, cut where a word ends in any case."""
    at = 0
    while len(text) - at > 2 * SLICE and (cut := CUT.search(text, at + SLICE)):
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


def merges(path: str) -> Merges:
    """This worker's counter for a vocabulary file."""
    kept = worker_cache("merges")
    if path not in kept:
        kept[path] = Merges(path)
    return kept[path]


def count_tokens(docs: DataFrame, path: str, limit: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    ``path``: a byte-level byte-pair vocabulary file of the tokenizers library, on every executor. The count is that of the
    library for the whole text without special tokens around it; the string of an added token inside a text is one token.
    A null text counts as empty: 0 bytes, 0 tokens. Rows stay as they are, one for each, with null and repeated ids too; no
    other column is read, so none can clash. An empty table gives no rows. Nothing is shuffled; a text is taken in slices.
    """
    small_batches(docs.sparkSession)
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = merges(path).count
        for batch in rows:
            texts = batch.column(1)
            n_bytes = [len(s.as_buffer()) if s.is_valid else 0 for s in texts]
            n_tokens = [count(s.as_py()) for s in texts]
            columns = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens"])

    counted = given.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
