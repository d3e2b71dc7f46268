"""Byte-pair encoding with word ends, and its inverse.

A text is cut at white space into chunks; a chunk is normalised (NFC, lower case) and cut
into words as the tokenizer file's pattern says.  Each distinct word is encoded once per
batch.  Short words are encoded together: row i of a matrix holds the parts of word i from
left to right, and a second matrix, just as contiguous, holds the rank of each adjacent
pair.  One step finds the leftmost minimal rank of every row, writes the merged part,
deletes the boundary (the rest of the row moves left by one) and looks up the two
neighbouring ranks again.  Words of more than ``SHORT`` bytes take the same merges in the
same order from a heap, as a scan of them would be quadratic.

Which words a worker has seen lately is kept in two generations of bounded size; that is
a cache only, it never changes a result.

Defined cases: a null text is an empty text, and an empty text has no ids; the texts of
special tokens inside a text become those tokens, as in the library.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyspan.llm.common import begin, concat_ranges, pick, plain, position, text_slices, without

SHORT = 64
CACHE_ENTRIES = 250_000
END = "</w>"
NONE = np.iinfo(np.int32).max

# The pre-tokenizer's pattern, for ASCII and for other text.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where it is a visible Latin-1
    letter, else the next free one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class Vocabulary:
    """Ids and merge ranks of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, at in [*ids.items(), *self.special.items()]:
            self.tokens[at] = token
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int32)
        self.last = np.array([ids[c + END] for c in letters], np.int32)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        pair = np.array([(ids[a] << 32) | ids[b] for a, b in merges], np.int64)
        order = np.argsort(pair, kind="stable")
        self.pairs, self.pair_rank = pair[order], order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where it has none or a side is missing (-1)."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (right >= 0) & (left >= 0), self.pair_rank[at], NONE)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (int32 bytes) of each word."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        out = [b""] * len(raw)
        low = 0
        for high in (4, 6, 8, 12, 16, 32, SHORT):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            for start in range(0, len(rows), 65_536):
                part = rows[start : start + 65_536]
                for i, ids in zip(part, self._short([raw[i] for i in part], sizes[part], high)):
                    out[i] = ids
        for i in np.flatnonzero(sizes > SHORT):
            out[i] = self._long(raw[i])
        return out

    def _short(self, raw: list[bytes], sizes: np.ndarray, width: int) -> Iterator[bytes]:
        letters = np.frombuffer(b"".join(raw), np.uint8)
        parts = np.full((len(raw), width), -1, np.int32)
        parts[np.arange(width) < sizes[:, None]] = self.inner[letters]
        ends = np.cumsum(sizes) - 1
        parts[np.arange(len(raw)), sizes - 1] = self.last[letters[ends]]
        done = parts.copy()
        live, columns = np.arange(len(raw)), np.arange(width)
        rank = np.full((len(raw), width), NONE, np.int32)
        rank[:, :-1] = self.ranks(parts[:, :-1], parts[:, 1:])
        while len(live):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(live)), at]
            go = best < NONE
            if not go.all():
                done[live[~go]] = parts[~go]
                live, parts, rank, at, best = live[go], parts[go], rank[go], at[go], best[go]
                if not len(live):
                    break
            rows = np.arange(len(live))
            moved = np.minimum(columns + (columns > at[:, None]), width - 1)
            parts = np.take_along_axis(parts, moved, axis=1)
            rank = np.take_along_axis(rank, moved, axis=1)
            parts[:, -1], rank[:, -1] = -1, NONE
            merged = self.merged[best]
            parts[rows, at] = merged
            after = np.where(at + 1 < width, parts[rows, np.minimum(at + 1, width - 1)], -1)
            rank[rows, at] = self.ranks(merged, after)
            has = at > 0
            rank[rows[has], at[has] - 1] = self.ranks(parts[rows[has], at[has] - 1], merged[has])
        counts = (done >= 0).sum(axis=1)
        return (row[:n].tobytes() for row, n in zip(done, counts))

    def _long(self, raw: bytes) -> bytes:
        """The same merges by a heap of (rank, position) and linked neighbours."""
        parts = self.inner[np.frombuffer(raw, np.uint8)].tolist()
        parts[-1] = int(self.last[raw[-1]])
        n = len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        known: dict[tuple[int, int], int] = {}

        def rank(a: int, b: int) -> int:
            if (a, b) not in known:
                known[a, b] = int(self.ranks(np.array([a]), np.array([b]))[0])
            return known[a, b]

        heap = [(r, i) for i in range(n - 1) if (r := rank(parts[i], parts[i + 1])) < NONE]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j < 0 or rank(parts[i], parts[j]) != best:
                continue
            parts[i], parts[j] = int(self.merged[best]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := rank(parts[a], parts[b])) < NONE:
                    heapq.heappush(heap, (r, a))
        return np.array([p for p in parts if p >= 0], np.int32).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by a blank: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Recent:
    """A dictionary in two generations: what was not used since the last change of
    generation is forgotten at the next one."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.limit:
            self.new, self.old = {}, self.new
        self.new[key] = value


class Encoder:
    """Encodes batches of texts; ``encode_words`` gives the ids (int32 bytes) of words and
    ``entry`` what is kept for a chunk of text, given its ids."""

    def __init__(
        self,
        vocab: Vocabulary,
        encode_words: Callable[[list[str]], list[bytes]],
        entry: Callable[[bytes], object] = lambda ids: ids,
        cache: int = CACHE_ENTRIES,
    ):
        self.special = {t: np.array([i], np.int32).tobytes() for t, i in vocab.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.encode_words, self.entry = encode_words, entry
        self.words, self.chunks = Recent(cache), Recent(cache)

    def split(self, chunk: str) -> list[str]:
        """Words of a chunk; the texts of special tokens stay as they are."""
        if "<|" in chunk and self.special:
            pieces = self.cut.split(chunk)
            return [w for i, p in enumerate(pieces) for w in ([p] if i % 2 else self._split(p))]
        return self._split(chunk)

    @staticmethod
    def _split(chunk: str) -> list[str]:
        if chunk.isascii():
            return ASCII_WORDS.findall(chunk.lower())
        chunk = unicodedata.normalize("NFC", chunk)
        # Only the capital sigma has a lower case that depends on its neighbours.
        lower = "".join(map(str.lower, chunk)) if "Σ" in chunk else chunk.lower()
        return WORDS.findall(lower)

    def lookup(self, chunks: list[str]) -> list:
        """The entry of every chunk."""
        found = list(map(self.chunks.get, chunks))
        missing = [i for i, x in enumerate(found) if x is None]
        split = [self.split(chunks[i]) for i in missing]
        words = set().union(*split)
        ids = {w: self.words.get(w) for w in words} | {w: x for w, x in self.special.items() if w in words}
        new = [w for w, x in ids.items() if x is None]
        for word, x in zip(new, self.encode_words(new)):
            ids[word] = x
            self.words.put(word, x)
        for i, words in zip(missing, split):
            found[i] = self.entry(b"".join([ids[w] for w in words]))
            self.chunks.put(chunks[i], found[i])
        return found

    def chunked(self, texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        """Entries of the distinct chunks, the chunk at each place, and where each text
        starts among these places (one more than there are texts)."""
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        coded = lists.flatten().dictionary_encode()
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        return self.lookup(coded.dictionary.to_pylist()), coded.indices.to_numpy(), starts


def encode_ids(encoder: Encoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts after one another, and where each text's ids start (one more)."""
    entries, at, starts = encoder.chunked(texts)
    flat = np.frombuffer(b"".join(entries), np.int32)
    sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
    begins = np.cumsum(sizes) - sizes
    ids = flat[concat_ranges(begins[at], sizes[at])]
    ends = np.concatenate([[0], np.cumsum(sizes[at])])
    return ids, ends[starts]


DIGEST_COLUMNS = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
]


@functools.lru_cache(maxsize=2)
def _digest_encoder(path: str) -> Encoder:
    vocab = vocabulary(path)

    def entry(ids: bytes) -> tuple[int, str, str]:
        ids = np.frombuffer(ids, np.int32).tolist()
        return len(ids), " ".join(map(str, ids)), vocab.decode(ids)

    return Encoder(vocab, vocab.encode_words, entry)


def _forget() -> None:
    _digest_encoder.cache_clear()
    vocabulary.cache_clear()


def _sha256(joined: pa.Array) -> list[str]:
    return [hashlib.sha256(x).hexdigest() for x in joined.cast(pa.large_binary()).to_pylist()]


def encoded_digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns but the text, and per row the number of ids and the SHA-256 digests of
    the ids (decimal, joined by a blank) and of the decoded text.

    Rows are handled where they are read: no shuffle.  A decoded text is that of its
    chunks joined by a blank, as no token spans two chunks.
    """
    rest = without(df, [text, *[f.name for f in DIGEST_COLUMNS]])
    kept = plain(df).select(*[f"c{position(df, c)}" for c in rest.columns], f"c{position(df, text)}")
    schema = T.StructType([*kept.schema.fields[:-1], *DIGEST_COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe", _forget)
        encoder, blank = _digest_encoder(path), pa.scalar(" ", pa.large_string())
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            counts, ids_sha, text_sha = [], [], []
            for start, length in text_slices(texts):
                entries, at, starts = encoder.chunked(texts.slice(start, length))
                n, decimal, decoded = map(list, zip(*entries)) if entries else ([], [], [])
                n = np.array(n, np.int64)
                full = n[at] > 0
                offsets = np.concatenate([[0], np.cumsum(full)])[starts]
                at = pa.array(at[full])
                counts.append(np.diff(np.concatenate([[0], np.cumsum(n[at.to_numpy()])])[offsets]))
                for strings, out in ((decimal, ids_sha), (decoded, text_sha)):
                    values = pa.array(strings, pa.large_string()).take(at)
                    out += _sha256(pc.binary_join(pa.LargeListArray.from_arrays(offsets, values), blank))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(np.concatenate(counts) if counts else [], pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(run, schema).toDF(*rest.columns, *[f.name for f in DIGEST_COLUMNS])


def encode(df: DataFrame, path: str, text: str = "text", name: str = "token_ids") -> DataFrame:
    """All columns and the ids of the text as an array of integers (a column of that name
    is replaced)."""
    kept = without(df, [name])
    at_text, names = position(kept, text), [*kept.columns, name]
    schema = T.StructType([*plain(kept).schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe", _forget)
        vocab = vocabulary(path)
        encoder = Encoder(vocab, vocab.encode_words)
        for batch in batches:
            for start, length in text_slices(batch.column(at_text)):
                part = batch.slice(start, length)
                ids, starts = encode_ids(encoder, part.column(at_text))
                lists = pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=schema.names)

    return plain(kept).mapInArrow(run, schema).toDF(*names)


def decode(df: DataFrame, path: str, ids: str = "token_ids", name: str = "decoded") -> DataFrame:
    """All columns and the text that the library decodes the ids to; null ids are none."""
    kept = without(df, [name])
    at, names = position(kept, ids), [*kept.columns, name]
    schema = T.StructType([*plain(kept).schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe", _forget)
        vocab = vocabulary(path)
        for batch in batches:
            texts = pa.array([vocab.decode(x or []) for x in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=schema.names)

    return plain(kept).mapInArrow(run, schema).toDF(*names)


def op4(documents: DataFrame, path: str) -> DataFrame:
    """The digest rows of the contract."""
    return encoded_digests(pick(documents, doc_id="doc_id", text="text"), path)
