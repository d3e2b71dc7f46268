"""Quality rules on repetition, from suffix arrays of whole texts.

The texts of a batch are one sequence of words, each text ended by a mark of its own, so that
nothing repeats across texts.  Its suffixes are sorted by prefix doubling: groups of
suffixes that agree in their first 1, 2, 4, ... words are split by the group of the suffix that
follows, and only groups with two or more suffixes go on.  The groups of every step stay, so
the longest common prefix of two neighbours in the suffix array is found by going down the
steps.  A suffix's deepest interval of common prefixes is given by the longer one of its two
prefixes in common with its neighbours; that is the longest repeat that starts there.  Repeats
of ``LEAST_WORDS`` words or more are maximal to the right by construction, and to the left
unless the word before starts a repeat longer by one.  The union of their spans is what is
covered; it is also the words of all runs of five that occur twice.

A word of more than ``LONG_WORD`` code points (a text without blanks, a blob) gets a suffix array
of its code points, those of a text together, with repeats of ``LEAST_CHARS`` or more, so a
repetition that has no word boundaries counts as well.

Rules: a text fails the base rules with fewer than ``LEAST_TEXT`` words or with more than a fifth of its
words in repeated runs.  The method's own limits are on the share of its code points that
repeats cover (``MOST_COVERED``, blanks left out) and on the longest repeat
(``LONGEST`` code points, words joined by one blank).

Memory: four bytes a word of a slice of ``text_slices`` (or of one longer text) for every doubling of
its longest repeat.

Defined cases: null, empty and blank texts have no words and fail; a text of one repeated
word is covered wholly; texts that are equal are measured each for itself; rows are neither
joined nor shuffled, so repeated ids and null ids stay as they are; columns named ``repetition``
are replaced, others stay; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.llm.common import begin, pick, plain, position, text_slices, tidy, without

LEAST_WORDS = 5
LONG_WORD = 64
LEAST_CHARS = 32
LEAST_TEXT = 10
MOST_REPEATED = 0.2  # of the words, base rule
MOST_COVERED = 0.25  # of the code points
LONGEST = 1000
SLICE = 4 << 20
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

MEASURES = "n_words bigint, word_chars bigint, n_repeat_words bigint, covered_chars bigint, longest_chars bigint"
REPETITION = f"struct<{MEASURES.replace(' bigint', ':bigint')},spans:array<struct<first_word:int,words:int>>>"


def longest_repeats(symbols: np.ndarray, least: int) -> np.ndarray:
    """For every position how many symbols from there on occur at another position as well;
    0 if fewer than ``least``.  The last symbol, and one in every stretch that is to be
    kept apart, occurs once."""
    n = len(symbols)
    kind = np.int32 if n < 1 << 31 else np.int64
    found = np.zeros(n, kind)
    active = np.argsort(symbols, kind="stable").astype(kind)
    key, old = symbols[active].astype(np.int64), np.zeros(n, kind)
    rank, levels, width = np.zeros(n, kind), [], 1
    while len(active):
        at = np.arange(len(active), dtype=kind)
        new = np.ones(len(active), bool)
        new[1:] = key[1:] != key[:-1]
        from_old = np.ones(len(active), bool)
        from_old[1:] = old[1:] != old[:-1]
        first = np.maximum.accumulate(np.where(new, at, 0))
        first_old = np.maximum.accumulate(np.where(from_old, at, 0))
        rank[active] = old + first - first_old
        levels.append(rank.copy())
        alone = new & np.append(new[1:], True)
        active = active[~alone]
        key = rank[active].astype(np.int64) * n + rank[active + width]
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old, width = rank[active], 2 * width
    suffixes = np.empty(n, kind)
    suffixes[rank] = np.arange(n, dtype=kind)
    # Neighbours that agree in the largest power of two up to ``least``; others share less.
    enough = min(least.bit_length() - 1, len(levels) - 1)
    a, b = suffixes[:-1], suffixes[1:]
    near = levels[enough][a] == levels[enough][b]
    a, b = a[near], b[near]
    common = np.zeros(len(a), kind)
    for step in range(len(levels) - 1, -1, -1):
        common += (levels[step][a + common] == levels[step][b + common]).astype(kind) << step
    found[b] = common
    found[a] = np.maximum(found[a], common)
    found[found < least] = 0
    return found


def marked(codes: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, place of every code): codes of different texts differ, and every text ends
    in a symbol of its own.  ``owner`` ascends."""
    span = int(codes.max(initial=0)) + 1
    place = np.arange(len(codes)) + owner
    symbols = np.empty(len(codes) + texts, np.int64)
    symbols[place] = owner * span + codes
    ends = np.cumsum(np.bincount(owner, minlength=texts)) + np.arange(texts)
    symbols[ends] = texts * span + np.arange(texts)
    return symbols, place


def covered(lengths: np.ndarray) -> np.ndarray:
    """Which positions lie in the repeat of any position."""
    change = np.zeros(len(lengths) + 1, np.int64)
    at = np.flatnonzero(lengths)
    change[at] += 1
    np.subtract.at(change, at + lengths[at], 1)
    return np.cumsum(change[:-1]) > 0


@dataclass
class Measures:
    """Arrays with an entry per text, and the spans of words that repeats cover."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_repeat_words: np.ndarray
    covered_chars: np.ndarray
    longest_chars: np.ndarray
    span_owner: np.ndarray
    span_first: np.ndarray
    span_words: np.ndarray


def measure(texts: pa.Array, least: int = LEAST_WORDS) -> Measures:
    """Repetition in each of the texts (no nulls)."""
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    number = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    words = split.flatten()
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    real = chars > 0  # a text of blanks alone splits into one empty word
    if not real.all():
        words, chars, number = words.filter(pa.array(real)), chars[real], number[real]
    n = len(texts)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    symbols, place = marked(codes, number, n)
    repeat = longest_repeats(symbols, least)[place] if len(symbols) else np.zeros(0, np.int32)
    inside = covered(repeat)
    total = np.concatenate([[0], np.cumsum(chars)])
    at = np.flatnonzero(repeat)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, number[at], total[at + repeat[at]] - total[at] + repeat[at] - 1)
    in_words = np.bincount(number, np.where(inside, chars, 0), minlength=n).astype(np.int64)

    # Words that are long, and not part of a repeat of words.
    long = np.flatnonzero((chars > LONG_WORD) & ~inside)
    if len(long):
        joined = "".join(words.take(pa.array(long)).to_pylist()).encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(joined, "<u4").astype(np.int64)
        word = np.repeat(np.arange(len(long)), chars[long])
        owners, numbered = np.unique(number[long], return_inverse=True)
        symbols, spot = marked(points, numbered[word], len(owners))
        symbols, spot = _apart(symbols, spot, word)
        again = longest_repeats(symbols, LEAST_CHARS)[spot]
        owner = number[long][word]
        in_words += np.bincount(owner, covered(again), minlength=n).astype(np.int64)
        np.maximum.at(longest, owner, again)

    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
    first, end = edge[::2], edge[1::2]
    # A span may run on into the next text, whose words start a repeat as well.
    starts = np.searchsorted(number, np.arange(n))
    cut = starts[(starts > 0) & (starts < len(inside))]
    cut = np.unique(cut[inside[cut] & inside[cut - 1]])
    first, end = np.sort(np.concatenate([first, cut])), np.sort(np.concatenate([end, cut]))
    return Measures(
        np.bincount(number, minlength=n),
        np.bincount(number, chars, minlength=n).astype(np.int64),
        np.bincount(number, inside, minlength=n).astype(np.int64),
        in_words,
        longest,
        number[first] if len(first) else first,
        first - starts[number[first]] if len(first) else first,
        end - first,
    )


def _apart(symbols: np.ndarray, spot: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A symbol of its own before every word but the first, so that repeats end with a word."""
    moved = spot + word
    out = np.empty(len(symbols) + int(word[-1]), np.int64)
    fresh = np.ones(len(out), bool)
    fresh[moved] = False
    out[moved] = symbols[spot]
    out[fresh] = symbols.max() + 1 + np.arange(int(fresh.sum()))
    return out, moved


def _as_array(found: Measures) -> pa.StructArray:
    n = len(found.n_words)
    spans = pa.StructArray.from_arrays(
        [pa.array(found.span_first, pa.int32()), pa.array(found.span_words, pa.int32())], names=["first_word", "words"]
    )
    offsets = np.searchsorted(found.span_owner, np.arange(n + 1)).astype(np.int32)
    counts = [found.n_words, found.word_chars, found.n_repeat_words, found.covered_chars, found.longest_chars]
    names = ["n_words", "word_chars", "n_repeat_words", "covered_chars", "longest_chars", "spans"]
    return pa.StructArray.from_arrays([*[pa.array(c, pa.int64()) for c in counts], pa.ListArray.from_arrays(offsets, spans)], names=names)


def with_repetition(df: DataFrame, text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """All columns and ``repetition``: what repeats of ``least_words`` words or more cover."""
    kept = without(df, ["repetition"])
    at, names = position(kept, text), [*kept.columns, "repetition"]
    schema = T.StructType([*plain(kept).schema.fields, T.StructField("repetition", T.DataType.fromDDL(REPETITION))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("repetition")
        for batch in batches:
            tidy()
            for start, length in text_slices(batch.column(at), SLICE):
                part = batch.slice(start, length)
                texts = pc.fill_null(part.column(at), "").cast(pa.large_string())
                columns = [*part.columns, _as_array(measure(texts, least_words))]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "repetition"])

    return plain(kept).mapInArrow(run, schema).toDF(*names)


def base_failed(found: Column) -> Column:
    """Too few words, or more than ``MOST_REPEATED`` of them in runs that repeat."""
    repeated = 100 * found["n_repeat_words"] > int(100 * MOST_REPEATED) * found["n_words"]
    return (found["n_words"] < LEAST_TEXT) | repeated


def within_limits(found: Column, most_covered: float = MOST_COVERED, longest: int = LONGEST) -> Column:
    """The method's verdict on a ``repetition``."""
    return (found["covered_chars"] <= most_covered * found["word_chars"]) & (found["longest_chars"] <= longest)


def keep_varied(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose texts pass all rules."""
    at = f"c{position(df, text)}"
    found = with_repetition(plain(df), at)
    good = ~base_failed(found["repetition"]) & within_limits(found["repetition"])
    return found.where(good).drop("repetition").toDF(*df.columns)


def symbol_count(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint")


def repeated_lines(text: Column) -> Column:
    """How many lines with a word equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def op11(documents: DataFrame) -> DataFrame:
    rows = pick(documents, doc_id="doc_id", text="text").withColumn("text", F.coalesce("text", F.lit("")))
    counted = rows.select(
        "doc_id", "text", symbol_count(F.col("text")).alias("n_symbols"), repeated_lines(F.col("text")).alias("n_dup_lines")
    )
    found = with_repetition(counted).drop("text")
    of = F.col("repetition")
    return found.select(
        "doc_id",
        of["n_words"].alias("n_words"),
        of["word_chars"].alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        of["n_repeat_words"].alias("n_repeat_words"),
        base_failed(of).alias("base_failed"),
        (~base_failed(of) & within_limits(of)).alias("kept"),
        of["covered_chars"].alias("covered_chars"),
        of["longest_chars"].alias("longest_chars"),
    )
