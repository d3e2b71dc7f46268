"""Document fingerprints by consistent weighted sampling.

A text's terms are its runs of ``TERM_WORDS`` words (cut at ASCII white space, lower case), each
weighted by how often it occurs; a shorter text is one term.  For sample k, term x and
weight w: r and c are Gamma(2, 1) variables and b is uniform, all three a function of
(x, k) alone; t = floor(ln w / r + b) and ln a = ln c - r (t + 1 - b).  The sample is
the (x, t) of the least a.  Two texts agree in a sample with a probability equal to the
generalised Jaccard similarity (sum of the smaller over sum of the larger weights).

The variables come from one 64-bit hash per (x, k) and tables of the quantiles of Gamma(2,
1), so no random number is stored.  A fingerprint has ``SAMPLES`` components of 16 bits as
hexadecimal digits; unequal samples meet in a component with probability 2^-16.

``neighbour_fingerprints`` also edits each text: its last quarter is replaced by the start of
the next document.  Rows are dealt by ranges of the id and each range also gets the first
row of the next one, so every text is shuffled once (and one text per range twice).  A task
keeps one batch of rows.

Defined cases: a null text is an empty text; all texts without a word share a fingerprint
of their own; equal texts have equal fingerprints.  Rows are in the order of the id, then of
the text's hash and the text, null ids last, so rows that share an id follow one another; the
row after the last one is the first; the only row of a table follows itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.llm.common import WORDS as known_words
from tallyspan.llm.common import begin, pick, plain, position, shingles, without

SAMPLES = 64
TERM_WORDS = 2
TABLE_BITS = 16
RANGE_BYTES = 32 << 20
MOST_RANGES = 20_000
BATCH_CHARS = 2 << 20
BLOCK_TERMS = 4096


def gamma_quantiles(bits: int) -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the middles of 2^bits equal shares, by Newton steps on
    its distribution function 1 - (1 + g) exp(-g)."""
    share = (np.arange(1 << bits) + 0.5) / (1 << bits)
    g = np.sqrt(2 * share) + 2 * share**2 - np.log1p(-share) * (share > 0.7)
    for _ in range(60):
        step = (1 - (1 + g) * np.exp(-g) - share) / (g * np.exp(-g))
        g = np.maximum(g - np.clip(step, -1, 1), 1e-6)
    return g


GAMMA = gamma_quantiles(TABLE_BITS).astype(np.float32)
# Kept positive, as positive floats are in the order of their bits.
LN_GAMMA = (np.log(gamma_quantiles(TABLE_BITS)) + 128).astype(np.float32)
SEEDS = np.random.default_rng(20).integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
LOW = np.uint64(0xFFFF)


def samples(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """[term, sample]: the bits of ln a (upper half) and a hash of (x, t) (lower half)."""
    mixed = terms[:, None] ^ SEEDS
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    r = GAMMA[mixed & LOW]
    b = ((mixed >> np.uint64(16)) & LOW).astype(np.float32)
    b += np.float32(0.5)
    b /= np.float32(65_536)
    height = LN_GAMMA[(mixed >> np.uint64(32)) & LOW]
    often = np.flatnonzero(weights > 1)
    name = (terms & np.uint64(0xFFFFFFFF))[:, None].repeat(SAMPLES, axis=1)
    if len(often):
        t = np.floor(np.log(weights[often]).astype(np.float32)[:, None] / r[often] + b[often])
        name[often] = (name[often] + t.astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
        b[often] -= t
    height -= r * (1 - b)
    packed = np.maximum(height, np.float32(1e-3)).view(np.uint32).astype(np.uint64)
    packed <<= np.uint64(32)
    return packed | name


def least(terms: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per segment of terms (``starts`` has one more entry) the least sample in each
    column; all ones for an empty segment.  Worked on in blocks of terms."""
    out = np.full((len(starts) - 1, SAMPLES), np.uint64(0xFFFFFFFFFFFFFFFF))
    for low in range(0, len(terms), BLOCK_TERMS):
        high = min(low + BLOCK_TERMS, len(terms))
        first = int(np.searchsorted(starts, low, "right")) - 1
        last = int(np.searchsorted(starts, high, "left"))
        cuts = np.clip(starts[first:last], low, high) - low
        some = np.flatnonzero(np.diff(np.append(cuts, high - low)) > 0)
        found = np.minimum.reduceat(samples(terms[low:high], weights[low:high]), cuts[some], axis=0)
        out[first + some] = np.minimum(out[first + some], found)
    return out


def fingerprints(texts: list[str], edited: list[str] | None = None) -> list[np.ndarray]:
    """Components [text, sample] of the texts, and of the edited texts.

    A text and its edit share most weighted terms; each distinct (term, weight) of the two
    is sampled once, in one of three segments: both, text only, edit only.
    """
    n = len(texts)
    value, owner = shingles(texts, TERM_WORDS)
    kind = np.zeros(len(value), np.int8)
    if edited is not None:
        more, of = shingles(edited, TERM_WORDS)
        value, owner = np.concatenate([value, more]), np.concatenate([owner, of])
        kind = np.concatenate([kind, np.ones(len(more), np.int8)])
    order = np.lexsort((kind, value, owner))
    value, owner, kind = value[order], owner[order], kind[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]) | (kind[1:] != kind[:-1])
    at = np.flatnonzero(new)
    value, owner, kind, weight = value[at], owner[at], kind[at], np.diff(np.append(at, len(new)))
    # A term of both with the same weight: the row of the text stands for the edit's too.
    twin = np.zeros(len(value), bool)
    twin[:-1] = (value[1:] == value[:-1]) & (owner[1:] == owner[:-1]) & (weight[1:] == weight[:-1])
    keep = np.ones(len(value), bool)
    keep[1:] = ~twin[:-1]
    segment = owner * 3 + np.where(twin, 0, 1 + kind)
    value, weight, segment = value[keep], weight[keep], segment[keep]
    order = np.argsort(segment, kind="stable")
    starts = np.searchsorted(segment[order], np.arange(3 * n + 1))
    found = least(value[order], weight[order], starts).reshape(n, 3, SAMPLES)
    sides = [found[:, [0, 1]].min(axis=1)] + ([found[:, [0, 2]].min(axis=1)] if edited is not None else [])
    out = []
    for side in sides:
        name = side & np.uint64(0xFFFFFFFF)
        name = (name ^ (name >> np.uint64(15))) * np.uint64(0x2C1B3C6D)
        out.append(((name >> np.uint64(16)) & LOW).astype(">u2"))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def edit(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _answers(rows: list[tuple[int | None, str]]) -> pd.DataFrame:
    """Rows of the result for all but the last of ``rows``, which only follows."""
    texts = [t for _, t in rows]
    edited = [edit(a, b) for a, b in zip(texts, texts[1:])]
    print_of, of_edited = fingerprints(texts, [*edited, ""])
    print_of, of_edited, following = print_of[:-1], of_edited[:-1], print_of[1:]
    return pd.DataFrame(
        {
            "doc_id": pd.array([k for k, _ in rows[:-1]], "Int64"),
            "n_chars": [len(t) for t in texts[:-1]],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
            "fingerprint": [x.tobytes().hex() for x in print_of],
            "edited_fingerprint": [x.tobytes().hex() for x in of_edited],
            "near_edited": likeness(print_of, of_edited),
            "near_next": likeness(print_of, following),
        }
    )


def _run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``batches``: sorted rows (range, extra, doc_id, text); ranges may follow one another,
    each ends with its extra row."""
    begin("cws", known_words.clear)
    held: list[tuple[int | None, str]] = []
    size = 0
    for batch in batches:
        keys = batch["doc_id"].astype("Int64")
        for key, text, extra in zip(keys, batch["text"], batch["extra"]):
            held.append((None if key is pd.NA else int(key), text))
            size += len(text)
            if extra or size >= BATCH_CHARS:
                if len(held) > 1:
                    yield _answers(held)
                held = [] if extra else held[-1:]
                size = 0 if extra else len(text)


def fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """All columns and the fingerprint of the text, without a shuffle."""
    kept = without(df, [name])
    at, names = f"c{position(kept, text)}", [*kept.columns, name]
    schema = T.StructType([*plain(kept).schema.fields, T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("cws", known_words.clear)
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.iloc[start : start + 256].copy()
                found = fingerprints([t if isinstance(t, str) else "" for t in part[at]])[0]
                part["fingerprint"] = [x.tobytes().hex() for x in found]
                yield part

    return plain(kept).mapInPandas(run, schema).toDF(*names)


def neighbour_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: fingerprints of the text and of its edit, and their likenesses."""
    spark = df.sparkSession
    rows = pick(df, doc_id=key, text=text).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint")), F.count("*"), F.count("doc_id")).first()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (total[0] or 0) // RANGE_BYTES)
    ranges = max(1, min(ranges, MOST_RANGES, total[2]))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0] if shares and total[2] else []
    cuts = sorted(set(cuts))
    # Ids up to the first cut are range 0.  Rows without an id are behind all others, in
    # ranges of equal shares of the text's hash.
    share = (F.col("hash") / F.lit(float(2**64)) + 0.5) * ranges
    number = _range_of(F.array(*[F.lit(c).cast("bigint") for c in cuts]), len(cuts)) if cuts else F.lit(0)
    unknown = F.lit(len(cuts) + 1) + F.least(share.cast("int"), F.lit(ranges - 1))
    placed = rows.withColumn("hash", F.xxhash64("text")).withColumn(
        "range", F.when(F.col("doc_id").isNull(), unknown).otherwise(number)
    )
    heads = sorted(tuple(r) for r in placed.groupBy("range").agg(F.min("doc_id")).collect())
    if not heads:
        return spark.createDataFrame([], SCHEMA)
    before = {r: heads[i - 1][0] for i, (r, _) in enumerate(heads)}
    # The first row of each range also ends the range before it.
    may_be_first = F.col("doc_id").isNull() | F.col("doc_id").isin([head for _, head in heads if head is not None])
    back = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    extra = (
        placed.where(may_be_first)
        .groupBy("range")
        .agg(F.min(F.struct("hash", "text")).alias("first"), F.min("doc_id").alias("doc_id"))
        .select("doc_id", "first.text", "first.hash", back[F.col("range")].alias("range"), F.lit(True).alias("extra"))
    )
    both = placed.withColumn("extra", F.lit(False)).unionByName(extra)
    order = ["range", "extra", F.col("doc_id").asc_nulls_last(), "hash", "text"]
    dealt = both.repartition(len(heads), "range").sortWithinPartitions(*order).drop("hash")
    return dealt.mapInPandas(_run, SCHEMA)


def _range_of(bounds, n: int):
    """Number of ``bounds`` (ascending) below the id, by halving."""
    low, high = F.lit(0), F.lit(n)
    steps = max(1, n.bit_length())
    state = F.struct(low.alias("low"), high.alias("high"))

    def halve(s, _):
        middle = F.shiftright(s["low"] + s["high"], 1)
        above = F.struct((middle + 1).alias("low"), s["high"].alias("high"))
        below = F.struct(s["low"].alias("low"), middle.alias("high"))
        half = F.when(F.element_at(bounds, middle + 1) < F.col("doc_id"), above).otherwise(below)
        return F.when(s["low"] >= s["high"], s).otherwise(half)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, halve)["low"]


def op7(documents: DataFrame) -> DataFrame:
    return neighbour_fingerprints(documents)
