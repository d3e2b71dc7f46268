"""Encoding and decoding against the library, over odd texts and every merge order."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyspan.llm import bpe
from tests.llm import data

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def encoded(texts):
    vocab = bpe.vocabulary(PATH)
    ids, starts = bpe.encode_ids(bpe.Encoder(vocab, vocab.encode_words), pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sStTrRe  \n<|>éÉΣİßﬁ½1²́̌\x1c\x85 😀中-_.J"), max_size=60), max_size=20))
def test_odd_texts(texts):
    assert encoded(texts) == [expected(t) for t in texts]


def test_special_tokens_and_long_words():
    texts = ["x<|endoftext|>y <|startoftext|>", "<|EndOfText|>", "a" * 1000, "ab" * 500 + "!" * 300, "the" * 2000, None, ""]
    assert encoded(texts) == [expected(t) for t in texts]


def test_short_and_long_words_merge_alike():
    vocab = bpe.vocabulary(PATH)
    words = ["intention", "aaaa", "ththth", "being", "ééé", "x" * 64]
    assert vocab.encode_words(words) == [vocab._long(w.encode()) for w in words]


def test_a_small_memory_changes_nothing():
    vocab = bpe.vocabulary(PATH)
    texts = [data.prose(__import__("random").Random(i), 50) for i in range(20)]
    small = bpe.Encoder(vocab, vocab.encode_words, cache=3)
    for text in texts:
        ids, _ = bpe.encode_ids(small, pa.array([text]))
        assert ids.tolist() == expected(text)


def test_digests(spark):
    df = data.messy(spark)
    got = {}
    for r in bpe.op4(df, PATH).collect():
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_sha256, r.decoded_sha256))
    want = {}
    for doc_id, text, *_ in df.collect():
        ids = expected(text)
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        row = len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded))
        want.setdefault(doc_id, []).append(row)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_round_trip_and_clashing_columns(spark):
    df = data.clashing(spark, ["token_ids", "a.b", "n_tokens", "c0"])
    coded = bpe.encode(df, PATH)
    assert coded.columns == [c for c in df.columns if c != "token_ids"] + ["token_ids"]
    for r in bpe.decode(coded, PATH).collect():
        assert r.token_ids == expected(r.text)
        assert r.decoded == LIBRARY.decode(r.token_ids, skip_special_tokens=False)
    assert bpe.encoded_digests(df, PATH).count() == df.count()


def test_empty_table(spark):
    assert bpe.op4(data.empty(spark), PATH).collect() == []


@pytest.mark.parametrize("width", [1, 5])
def test_ranges(width):
    starts, lengths = np.array([0, 10, 3]), np.array([width, 0, 2])
    assert bpe.concat_ranges(starts, lengths).tolist() == [*range(width), 3, 4]
