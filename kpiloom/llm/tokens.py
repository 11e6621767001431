"""Token ids of whole texts with a vocabulary file of the tokenizers library.

Both vocabularies used here split a text into words before their merges run, so a text's ids are the ids of its words in
a row. A worker keeps the ids of the words it has seen; only new words go through the library. Each text is cut only
where the tokenizer cuts too:

* ``byte`` (byte-level): before a single space or line feed that a word follows, and between Latin letters and the
  punctuation after them;
* ``word`` (white space dropped): at spaces and line feeds, and between Latin letters and the punctuation after them.

Everything else stays inside a chunk and is encoded by the library as it is. A text that holds the string of an added token
(such as ``<|endoftext|>``) goes through the library whole, as the library cuts at these strings before all else.
"""

from __future__ import annotations

import re

import numpy as np

from kpiloom.llm.common import worker_cache

#: Words kept by one worker, in each of two generations: a full one becomes the older, from which words are taken back.
KEPT_WORDS = 400_000
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
CHUNKS = {
    "byte": re.compile(rf" ?[{LETTERS}]++(?=[ \n.,;:!?#*$%&|])| ?[^ \n]+|[ \n]+(?=[ \n][^ \n])|[ \n]+\Z|\n"),
    "word": re.compile(rf"[{LETTERS}]++(?=[ \n.,;:!?#*$%&|])|[^ \n]+"),
}
#: White space other than space and line feed; words joined by it stay in one chunk, with all white space around it.
OTHER = "\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RARE = re.compile(f"[{OTHER}]")
JOINED = re.compile(rf" ?[^ \n{OTHER}]*(?:[ \n]*[{OTHER}][ \n{OTHER}]*[^ \n{OTHER}]*)+|" + CHUNKS["byte"].pattern)
PURE = re.compile(rf" ?[{LETTERS}]{{1,40}}")


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def byte_chunks(text: str) -> list[str]:
    return (JOINED if RARE.search(text) else CHUNKS["byte"]).findall(text)


class Encoder(dict):
    """Ids (little-endian, ``dtype``) by chunk of text; without ``added``, strings of added tokens are ordinary text."""

    def __init__(self, path: str, added: bool = False) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        tokens = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.added = re.compile("|".join(map(re.escape, tokens))) if tokens else None
        self.drops_space = not self.tokenizer.encode(" ", add_special_tokens=False).ids
        self.chunks = CHUNKS["word"].findall if self.drops_space else byte_chunks
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model = self.tokenizer.model
        self.letters = byte_letters()

    def __missing__(self, chunk: str) -> bytes:
        value = self.older.pop(chunk, None)
        if value is None:
            if PURE.fullmatch(chunk):  # one word: straight to the merges
                word = chunk.lower() if self.drops_space else chunk
                ids = [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]
            else:
                ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            value = np.array(ids, self.dtype).tobytes()
        if len(chunk) <= 48:
            if len(self) >= KEPT_WORDS:
                self.older = dict(self)
                self.clear()
            self[chunk] = value
        return value

    def encode(self, text: str | None) -> bytes:
        if text and self.added and self.added.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        return b"".join(map(self.__getitem__, self.chunks(text))) if text else b""


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file, with the library's own reading of added tokens."""
    kept = worker_cache("encoders")
    if path not in kept:
        kept[path] = Encoder(path, added=True)
    return kept[path]
