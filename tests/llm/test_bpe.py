import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from millrace.llm.bpe import bpe_decode, bpe_digests, bpe_encode, coder, decode, token_table
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)
ODD = ["", " ", "Don't  we'll\tgo\n\n", "ÀÉ ß ẞ İ ΣΑΣ Σ.", "é ﬁ ①½ 12,345", "x" * 3000, "a b c　d\x1ce\x85f​g", "<|endoftext|> a<|startoftext|>b <|endof", "日本語 中文 🙂👩‍👩‍👧 힣", "\x00\x01\x7f", "'S 'RE it'D qxqzjq ǅ Ǆ"]


def same(text):
    own, lib = coder(PATH), LIB.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == lib, text
    assert decode(token_table(PATH), lib) == LIB.decode(lib, skip_special_tokens=False)


@pytest.mark.parametrize("text", ODD)
def test_equals_the_library(text):
    same(text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_equals_the_library_on_any_text(text):
    same(text)


@settings(max_examples=150, deadline=None)
@given(st.text("abcdefghinorst-=_", min_size=50, max_size=400))
def test_long_words_equal_the_library(text):
    same(text)


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "acgt", "-", "=", "ab"])
def test_long_words_take_little_more_than_linear_time(letters):
    rng = random.Random(5)
    word = "".join(rng.choice(letters) for _ in range(40_000))
    same(word[:3000])
    own, start = coder(PATH), time.perf_counter()
    ids = own.encode(word)
    assert time.perf_counter() - start < 2
    assert "".join(token_table(PATH)[i] for i in ids).removesuffix(own.end) == word


def test_caches_keep_no_long_words():
    own = coder(PATH)
    for i in range(50):
        own.encode(f"{i}" + "xy" * 5000)
    assert max(map(len, own.chunks)) <= 64 >= max(map(len, own.words))


def test_odd_rows(spark):
    rows = [(None, "a b", 1), (None, "a b", 2), ("x", "a b", 3), ("x", "c", 4)]
    got = bpe_digests(spark.createDataFrame(rows, "doc_id string, text string, ids int"), PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((str(r.doc_id), r.n_tokens) for r in got.collect()) == [("None", 2), ("None", 2), ("x", 1), ("x", 2)]


def test_table(spark):
    rows = [(1, "Hello, World"), (2, None), (2, ""), (3, "x " * 5000)]
    got = sorted(tuple(r) for r in bpe_digests(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect())

    def want(i, t):
        ids = LIB.encode(t or "", add_special_tokens=False).ids
        return (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest())

    assert got == sorted(want(i, t) for i, t in rows)
    assert bpe_digests(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
    apart = bpe_decode(bpe_encode(spark.createDataFrame(rows, "doc_id long, text string"), PATH), PATH)
    assert sorted((r.doc_id, r.decoded) for r in apart.collect()) == sorted((i, LIB.decode(LIB.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, t in rows)
