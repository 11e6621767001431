"""Packing and Arrow files against the tokenizers library used plainly."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kpiloom.llm import arrowfiles, packing, queries
from kpiloom.llm.tokens import Encoder

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def plain(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), encoder.dtype).tolist()


ENCODERS = [(Encoder(p), plain(p)) for p in (WORD, BYTE)]
TEXT = st.text(st.sampled_from("abZé ñß  \n\n\t.,'s!09²漢\u0301\u00a0\u2028ΣＡİ<|>"), max_size=40)


@pytest.mark.parametrize("own, reference", ENCODERS)
@given(text=TEXT)
@settings(max_examples=400, deadline=None)
def test_chunks_give_the_ids_of_the_whole_text(own, reference, text):
    assert ids_of(own, text) == reference(text)


@pytest.mark.parametrize("own, reference", ENCODERS)
def test_special_words_and_corpus(own, reference, corpus):
    for text in [*(r[1] for r in corpus), "<|endoftext|> a<|startoftext|>", "it's we'll 'tis", " lead", "trail \n ", "a" * 5000]:
        assert ids_of(own, text) == reference(text)


def test_pack(spark, documents, corpus, tmp_path):
    ids = {r[0]: [*plain(WORD)(r[1]), 1] for r in corpus}
    rows = packing.pack(documents, WORD, window=64, group_documents=60).collect()
    seen, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        assert list(np.frombuffer(r.ids, "<u4")) == ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id])
        seen[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    assert {k: sum(n for _, n in v) for k, v in seen.items()} == {k: len(v) for k, v in ids.items()}
    for pieces in [*seen.values(), *windows.values()]:
        at = 0
        for start, n in sorted(pieces):
            assert start == at
            at += n
    assert max(sum(n for _, n in v) for v in windows.values()) <= 64
    assert sum(map(len, ids.values())) / (64 * len(windows)) > 0.97
    # best fit decreasing fills as well as the plain search over all open windows
    whole = packing.sequences(packing.pack(documents, WORD, window=64), window=64).collect()
    assert all(len(r.ids) == 256 and not any(r.ids[4 * r.n_tokens :]) for r in whole)


@given(st.lists(st.integers(1, 40), max_size=60))
@settings(max_examples=200, deadline=None)
def test_place_is_best_fit(sizes):
    window = 16
    sizes = sorted(sizes, key=lambda n: -(n % window))
    free, expected = [], []
    for n in sizes:
        expected += [window] * (n // window)
        if rest := n % window:
            fits = [k for k, f in enumerate(free) if f >= rest]
            best = min(fits, key=lambda k: free[k]) if fits else None
            if best is None:
                free.append(window - rest)
            else:
                free[best] -= rest
    placed = list(packing.place(enumerate(sizes), window, 0))
    fill = defaultdict(int)
    for _, _, length, _, sequence, offset in placed:
        assert offset == fill[sequence]
        fill[sequence] += length
    assert sorted(fill.values()) == sorted([*(window - f for f in free), *expected])


def test_pack_edge_cases(odd, empty):
    rows = packing.pack(odd, WORD).collect()
    assert sum(r.start == 0 for r in rows) == odd.count()
    assert sorted(r.doc_tokens for r in rows if r.doc_tokens == 1) == [1, 1, 1, 1]
    assert packing.pack(empty, WORD).collect() == []


def test_groups_follow_bytes_and_equal_rows_are_dealt(spark):
    from pyspark.sql import functions as F

    rows = [(None, "a b c d e f g h " * 40)] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    packed = packing.pack(df, WORD, window=2048, group_bytes=20_000)
    groups = packed.groupBy(F.shiftright("sequence_id", 40).alias("g")).agg(F.count("*").alias("n")).collect()
    assert len(groups) > 4 and max(r.n for r in groups) < 150 and sum(r.n for r in groups) == 300


def test_arrow_files(spark, documents, corpus, monkeypatch):
    monkeypatch.setattr(arrowfiles, "BATCH_SEQUENCES", 3)
    ids = [[*plain(BYTE)(r[1]), 2] for r in sorted(corpus)]
    path = arrowfiles.write_sequences(documents, BYTE, window=32, parts=3)
    rows = sorted(arrowfiles.read_checksums(spark, path).collect())
    at = 0
    for r, own in zip(rows, ids, strict=True):
        assert (r.start, r.n_tokens) == (at, len(own))
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        at += len(own)
    flat = [x for own in ids for x in own]
    for name, start, n in {(r.file, r.start - r.at, 0) for r in arrowfiles.read_manifest(spark, path).collect()}:
        reader = arrowfiles.SequenceReader(f"{path}/files/{name}")
        assert isinstance(reader.source, pa.MemoryMappedFile)
        values, mask = reader.sequence(4)
        assert values.tolist() == flat[start + 128 : start + 160] and mask.all()


def test_arrow_files_edge_cases(spark, odd, empty):
    rows = arrowfiles.read_checksums(spark, arrowfiles.write_sequences(odd, BYTE, parts=4)).collect()
    assert len(rows) == odd.count()
    assert sorted(r.start for r in rows)[0] == 0
    rows.sort(key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x or 0))
    assert arrowfiles.read_checksums(spark, arrowfiles.write_sequences(empty, BYTE)).collect() == []


def test_queries_on_the_smallest_tables(spark):
    packed = queries.op1_packing(spark, "/root/testdata/sf0.001").toPandas()
    stored = queries.op9_arrow_files(spark, "/root/testdata/sf0.001").toPandas()
    assert packed.doc_id.nunique() == len(stored) == stored.doc_id.nunique()


ADDED = ["a<|endoftext|>b", "x <|endoftext|> y", " <|endoftext|>\n\n b", "<|startoftext|> a<|startoftext|>", "no token <|here|>", "<|ENDOFTEXT|>"]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_added_tokens_are_read_as_the_library_reads_them(path):
    tokenizer, own = Tokenizer.from_file(path), Encoder(path, added=True)
    for text in ADDED:
        assert ids_of(own, text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_operators_read_added_tokens(spark):
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    packed = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.pack(docs, WORD).collect()}
    assert packed == {i: [*word.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(ADDED)}
    stored = arrowfiles.read_checksums(spark, arrowfiles.write_sequences(docs, BYTE, parts=2)).collect()
    expected = {i: [*byte.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(ADDED)}
    assert {r.doc_id: r.ids_crc32 for r in stored} == {i: zlib.crc32(np.array(ids, "<u4").tobytes()) for i, ids in expected.items()}
