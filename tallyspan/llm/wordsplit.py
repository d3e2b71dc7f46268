"""Words of a batch of whole texts, cut at the level of bytes, all texts at once.

A word is what the tokenizer's pattern cuts out of a lower-cased chunk between blanks: letters, one
digit, other signs, or a contraction ('s 't 're 've 'm 'll 'd).  Letters are those of ASCII and of the upper
half of Latin-1, whose lower case is one step of a byte.  A chunk with any other character,
or with the beginning of a special token's text, is left whole and as it is, for the library.
"""

from __future__ import annotations

import functools
import os
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyspan.llm.bpe import vocabulary

SPACE, LETTER, DIGIT, SIGN, ODD = range(5)
KINDS = np.full(256, ODD, np.uint8)
KINDS[:128] = SIGN
KINDS[np.frombuffer(string.ascii_letters.encode(), np.uint8)] = LETTER
KINDS[np.frombuffer(string.digits.encode(), np.uint8)] = DIGIT
KINDS[np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)] = SPACE
LATIN = 0xC3  # first byte of U+00C0 to U+00FF
NO_LETTERS = (0x97, 0xB7)  # second bytes of the signs for times and divided by
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")


def _kinds(data: np.ndarray) -> np.ndarray:
    """Kind of every byte; all bytes of a chunk that is left whole are ``ODD``."""
    kinds = KINDS[data]
    high = np.flatnonzero(data == LATIN)
    high = high[~np.isin(data[high + 1], NO_LETTERS)]
    kinds[high], kinds[high + 1] = LETTER, LETTER
    kinds[np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))] = ODD
    odd = np.flatnonzero(kinds == ODD)
    if len(odd):
        blanks = np.flatnonzero(kinds == SPACE)
        chunk = np.unique(np.searchsorted(blanks, odd))
        change = np.zeros(len(data) + 1, np.int8)
        change[np.where(chunk > 0, blanks[chunk - 1] + 1, 0)] += 1
        change[blanks[chunk]] -= 1
        kinds[np.cumsum(change[:-1], dtype=np.int8) > 0] = ODD
    return kinds


def split_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words (and runs of blanks), the kind of each, the word at each place, and where
    each text starts among these places (one more than there are texts)."""
    nothing, blank = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    ended = pc.binary_join_element_wise(texts.cast(pa.large_string()).fill_null(""), nothing, blank)
    offsets = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset : ended.offset + len(ended) + 1]
    if offsets[-1] == offsets[0]:
        return [], np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(ended.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].copy()
    kinds = _kinds(data)
    letters = kinds == LETTER
    data[letters & (data - np.uint8(ord("A")) < 26)] += 32
    second = np.flatnonzero(letters & (data == LATIN)) + 1
    data[second[data[second] < 0x9F]] += 32

    new = np.empty(len(data), bool)
    new[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=new[1:])
    new |= kinds == DIGIT
    quote = np.flatnonzero((data == ord("'")) & new & (kinds == SIGN))
    quote = quote[letters[quote + 1]]
    for letters_after in CONTRACTIONS:
        at = quote[data[quote + 1] == ord(letters_after[0])]
        if len(letters_after) == 2:
            at = at[data[at + 2] == ord(letters_after[1])]
        new[at + 1] = False
        new[at + 1 + len(letters_after)] = True

    starts = np.flatnonzero(new)
    ends = np.append(starts, len(data))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    coded = words.dictionary_encode()
    codes, kinds = coded.indices.to_numpy(zero_copy_only=False), kinds[starts]
    of_word = np.empty(len(coded.dictionary), np.uint8)
    of_word[codes] = kinds
    real = kinds != SPACE
    return coded.dictionary.to_pylist(), of_word, codes[real], np.searchsorted(starts[real], offsets - offsets[0])


class WordIds:
    """Ids of words as the library gives them, worked out once for those remembered (a bounded
    number): by the merges of ``Vocabulary`` for all new words of a batch at once, and by the library for
    chunks that were left whole."""

    def __init__(self, path: str, limit: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.vocabulary = vocabulary(path)
        self.limit, self.known = limit, {}

    def of(self, words: list[bytes], kinds: np.ndarray) -> list[bytes]:
        """32-bit ids of each word; none of blanks."""
        found = list(map(self.known.get, words))
        for i in np.flatnonzero(kinds == SPACE):
            found[i] = b""
        missing = [i for i, ids in enumerate(found) if ids is None]
        plain = [i for i in missing if kinds[i] != ODD]
        odd = [i for i in missing if kinds[i] == ODD]
        for i, ids in zip(plain, self.vocabulary.encode_words([words[i].decode() for i in plain])):
            self.known[words[i]] = found[i] = ids
        coded = self.library.encode_batch_fast([words[i].decode() for i in odd], add_special_tokens=False)
        for i, x in zip(odd, coded):
            self.known[words[i]] = found[i] = array("i", x.ids).tobytes()
        if len(self.known) > self.limit:
            self.known = dict(zip(words, found))
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after one another, and where each text's ids start (one more)."""
        words, kinds, at, starts = split_words(texts)
        entries = self.of(words, kinds)
        flat = np.frombuffer(b"".join(entries), np.int32)
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        begins = np.cumsum(sizes) - sizes
        sizes = sizes[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = flat[np.repeat(begins[at] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[starts]


@functools.lru_cache(maxsize=2)
def word_ids(path: str, limit: int) -> WordIds:
    return WordIds(path, limit)


def forget() -> None:
    word_ids.cache_clear()
    vocabulary.cache_clear()
