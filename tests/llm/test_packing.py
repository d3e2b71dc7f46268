"""Pieces cover every document once, windows hold no more than their capacity."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyspan.llm import packing
from tallyspan.llm.differencing import difference
from tests.llm import data

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1000), max_size=60), st.integers(1, 9), st.booleans())
def test_every_size_has_a_part(sizes, ways, balanced):
    parts = difference(np.array(sizes), ways, balanced)
    assert len(parts) == len(sizes)
    assert all(0 <= p < ways for p in parts)
    if balanced:
        assert max(Counter(parts.tolist()).values(), default=0) <= -(-len(sizes) // ways)


def test_differencing_of_two_known_sets():
    # 8, 7, 6, 5, 4: the differences 8-7, 6-5, 4-1, 3-1 leave 2.
    parts = difference(np.array([8, 7, 6, 5, 4]), 2)
    sums = np.bincount(parts, weights=[8, 7, 6, 5, 4])
    assert abs(sums[0] - sums[1]) == 2


def test_differencing_is_tighter_than_greedy():
    sizes = np.random.default_rng(1).integers(1, 10_000, 400)
    sums = np.bincount(difference(sizes, 8), weights=sizes)
    greedy = np.zeros(8)
    for s in sorted(sizes, reverse=True):
        greedy[greedy.argmin()] += s
    assert np.ptp(sums) < np.ptp(greedy)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 512), max_size=80))
def test_windows_hold_their_capacity(sizes):
    at = packing.windows(np.array(sizes, np.int64), 512)
    sums = np.bincount(at, weights=sizes) if sizes else np.zeros(0)
    assert (sums <= 512).all()


def check(df, packed, capacity):
    ids = defaultdict(list)
    for r in df.collect():
        ids[r.doc_id].append((*LIBRARY.encode(r.text or "", add_special_tokens=False).ids, 1))
    got = Counter()
    pieces = packed.collect()
    for r in pieces:
        found = [x for x in ids[r.doc_id] if len(x) == r.doc_tokens]
        crc = [zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) for x in found]
        assert r.ids_crc32 in crc
        assert 0 < r.length <= capacity
        got[r.doc_id] += r.length
    assert got == Counter({k: sum(map(len, v)) for k, v in ids.items()})
    windows = defaultdict(list)
    for r in pieces:
        windows[r.sequence_id].append((r.offset, r.length))
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(windows) == list(range(len(windows)))
    return sum(got.values()) / (capacity * max(1, len(windows)))


@pytest.mark.parametrize("capacity,piece,group", [(2048, 512, 512 * 2048), (64, 16, 2000)])
def test_messy_documents(spark, capacity, piece, group):
    df = data.messy(spark)
    packed = packing.pack(df, PATH, capacity=capacity, piece=piece, group_tokens=group)
    assert check(df, packed, capacity) > 0.9


def test_other_columns_do_not_matter(spark):
    df = data.clashing(spark, ["key", "start", "_group", "a.b"])
    check(df, packing.pack(df, PATH), packing.CAPACITY)


def test_empty_table(spark):
    assert packing.pack(data.empty(spark), PATH).collect() == []
