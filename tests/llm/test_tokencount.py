"""Token counts by merging against the tokenizers library."""

import random
import sys

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kpiloom.llm import queries, tokencount

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = tokencount.Merges(PATH)


def reference(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@given(st.text(max_size=60) | st.text(st.sampled_from("abZé ñß  \n\n\t.,'s!09²漢́  \x1c\x85ΣＡİ<|>"), max_size=60))
@settings(max_examples=600, deadline=None)
def test_any_text(text):
    assert OWN.count(text) == reference(text)


def test_corpus_and_added_tokens(corpus):
    texts = [r[1] for r in corpus] + ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|>\n\n<|endoftext|> x", "<|ENDOFTEXT|>"]
    for text in [*texts, "a" * 30_001, "ab" * 20_000, " " * 9_000, "\n" * 5_000 + "x", "it's we'll 'tis"]:
        assert OWN.count(text) == reference(text)


def test_every_letter_that_is_not_given_to_the_library_is_cut_as_there():
    cut = LIBRARY.pre_tokenizer.pre_tokenize_str
    for code in range(sys.maxunicode + 1):
        letter = chr(code)
        if 0xD800 <= code < 0xE000 or tokencount.OTHER.search(letter):
            continue
        text = f"a{letter}1{letter}.{letter} {letter}{letter}x"
        assert [text[i:j] for _, (i, j) in cut(text)] == tokencount.WORDS.findall(text), hex(code)


@pytest.mark.parametrize("spaces", [True, False])
def test_long_texts_are_cut_where_words_end(monkeypatch, spaces):
    monkeypatch.setattr(tokencount, "SLICE", 50)
    rng = random.Random(3)
    letters = "ab c. d\n1é'" if spaces else "abc1é'"
    text = "".join(rng.choice(letters) for _ in range(6000)) + " tail here"
    assert "".join(tokencount.slices(text)) == text
    assert OWN.count(text) == reference(text)


def test_full_store_of_words(monkeypatch):
    monkeypatch.setattr(tokencount, "KEPT_WORDS", 3)
    own = tokencount.Merges(PATH)
    text = "one two three four five one two six seven one " * 5
    assert own.count(text) == reference(text) and len(own) <= 3


def test_tables(spark, documents, corpus, odd, empty):
    rows = tokencount.count_tokens(documents, PATH, 100).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        r[0]: (len(r[1].encode()), reference(r[1]), reference(r[1]) > 100) for r in corpus
    }
    clash = odd.selectExpr("*", "1 as id", "2 as n_tokens", "3 as N_BYTES", "4 as `a.b`")
    rows = tokencount.count_tokens(clash, PATH, 1024).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in rows) == sorted((r.doc_id or -1, reference(r.text)) for r in odd.collect())
    assert tokencount.count_tokens(empty, PATH, 1).collect() == []
    named = spark.createDataFrame([("x", "a b"), (None, None)], "`my id` string, `the.text` string")
    out = tokencount.count_tokens(named, PATH, 1, id_col="my id", text_col="the.text")
    assert sorted(map(tuple, out.collect()), key=str) == [("x", 3, 2, True), (None, 0, 0, False)]


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = queries.op13_token_count(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, rows)) == sorted(
        (r.doc_id, len((r.text or "").encode()), reference(r.text), reference(r.text) > 1024) for r in docs
    )
