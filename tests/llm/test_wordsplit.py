from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tallyspan.llm.wordsplit import WordIds, split_words
from tests.llm import data

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def odd_texts(seed, count):
    rng = random.Random(seed)
    pieces = [
        "'", "''", "'s", "'S", "'re", "'ll", "'v", "'ve", "'m", "'d", "'t", "r", "e", "the", "THE", "Ä", "é", "ÿ", "À", "ß", "×", "÷", "ª",
        "µ", "é", "́", "İ", "Σ", "ς", "1", "42", "７", "Ⅷ", " ", "  ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x85", " ",
        " ", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<", "|", "!", "...", "#$%", "-", "漢字", "😀", "𝒳", "\x00", "\x7f", "'é", "é's",
    ]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(count)]


def check(library, texts, limit=1000):
    ids, starts = WordIds(PATH, limit).encode(pa.array(texts, pa.string()))
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(starts) == len(texts) + 1
    for i, w in enumerate(want):
        assert ids[starts[i] : starts[i + 1]].tolist() == w, repr(texts[i])


@pytest.mark.parametrize("seed", [1, 2])
def test_ids_are_the_library_s(library, seed):
    check(library, odd_texts(seed, 4000))


def test_latin_prose_and_odd_rows(library):
    rng = random.Random(3)
    latin = ["Über", "ÀÉÎ", "naïve", "l'été", "Don't", "WE'RE", "it's", "o'clock", "a1b2", "x.y", "(so)", "Æsop", "þing"]
    texts = [data.prose(rng, 50) + " " + " ".join(rng.choice(latin) for _ in range(30)) for _ in range(40)]
    check(library, [*texts, None, "", " ", "ab" * 3000, "7" * 500, *[r[1] for r in data.rows() if r[1] is None or len(r[1]) < 3000]])


def test_what_is_remembered_changes_nothing(library):
    coder = WordIds(PATH, 20)
    for seed in range(4):
        texts = odd_texts(seed, 200)
        ids, starts = coder.encode(pa.array(texts))
        assert np.diff(starts).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_nothing():
    assert [len(x) for x in split_words(pa.array([], pa.string()))] == [0, 0, 0, 1]
    ids, starts = WordIds(PATH, 10).encode(pa.array([None, ""], pa.string()))
    assert len(ids) == 0 and starts.tolist() == [0, 0, 0]
