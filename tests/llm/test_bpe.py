"""BPE against the tokenizers library, word by word and text by text."""

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quayside.llm.bpe import WordBpe, encode_decode

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = WordBpe(PATH)

TEXTS = [
    "", " ", "\n\t", "a", "Hello, World! it's we're they'LL 'S", "ΑΣ ΣΑΣ ὈΔΥΣΣΕΎΣ", "İstanbul ǅ ﬁ", "é Å ö",
    "<|startoftext|>a <|endoftext|>b<|endoftext", "1234 ½ ² ٣", "x\x1cy\x85z w　v​u", "日本語 テスト 🙂🙂‍🙂",
    "a" * 5000, "ab" * 700 + " " + "!" * 900, "\x00\x01﻿", "don't'sx 'd",
]


def check(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == want
    decoded = LIBRARY.decode(want, skip_special_tokens=False)
    assert OWN.decode(want) == decoded
    assert OWN.row(text) == (len(want), " ".join(map(str, want)), decoded)


@pytest.mark.parametrize("text", TEXTS)
def test_equals_library(text):
    check(text)


@settings(max_examples=1500, deadline=None)
@given(st.text(st.characters(codec="utf-8", exclude_categories=["Cn", "Cs"]), max_size=60))
def test_any_text(text):
    check(text)


def test_rows(spark):
    rows = [(1, "The end", "x"), (1, "The end", "y"), (2, None, "z"), (None, "", None), (3, "long " * 30000, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(encode_decode(docs, PATH, with_text=True).collect(), key=repr)
    assert len(got) == 5
    empty = hashlib.sha256(b"").hexdigest()
    for r in got:
        if r.n_tokens == 0:
            assert (r.ids_sha256, r.decoded_sha256, r.token_ids, r.decoded) == (empty, empty, [], "")
    by = {r.doc_id: r for r in got if r.n_tokens}
    assert by[3].n_tokens == 30000 and by[1].decoded == "the</w> end</w>"
    assert encode_decode(docs.limit(0), PATH).count() == 0


def test_whole_table_equals_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in encode_decode(docs, PATH).collect()}
    for d in docs.collect():
        ids = LIBRARY.encode(d.text or "", add_special_tokens=False).ids
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_the_word_table_holds_no_strings_but_the_words():
    bpe = WordBpe(PATH)
    bpe.row("some words, twice: some words 12 <|endoftext|> über")
    assert {"some", "words", "twice", "über"} <= set(bpe.written)
    for word, ids in bpe.written.items():
        assert isinstance(ids, tuple) and list(ids) == bpe.word(word) and all(any(i is k for k in bpe.ids.values()) for i in ids)
