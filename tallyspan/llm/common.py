"""Helpers that several operators of this folder share."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLICE_BYTES = 8 << 20
HOT_SHARE = 2048
KNOWN_WORDS = 100_000


ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def share_package(spark: SparkSession) -> None:
    """Python workers find the package where the driver found it, and get texts in smaller
    batches than Spark's default of 10,000 rows, unless the session says otherwise."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", PACKAGE_ROOT)
    if spark.conf.get(ROWS_PER_BATCH) == "10000":
        spark.conf.set(ROWS_PER_BATCH, "2000")


_remembered: dict[str, Callable[[], object]] = {}


def begin(operator: str, forget: Callable[[], object] | None = None) -> None:
    """To be called first in a task.  A worker process serves the tasks of one stage after
    another: what it remembers for an operator (by ``forget``) is dropped when a task of
    another one begins, so caches do not add up."""
    for other in [o for o in _remembered if o != operator]:
        _remembered.pop(other)()
    if forget is not None:
        _remembered[operator] = forget
    tidy()


def tidy() -> None:
    """Gives freed memory back to the system: a worker that keeps what its largest batch took
    shares its executor's memory with the JVM all the time."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def position(df: DataFrame, name: str) -> int:
    """Place of the column of that name; one in another case only where it is the only one."""
    if name in df.columns:
        return df.columns.index(name)
    same = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if len(same) != 1:
        raise ValueError(f"{len(same)} columns could be {name}")
    return same[0]


def plain(df: DataFrame) -> DataFrame:
    """The columns named by their places, c0, c1 and so on: no name clashes or needs quotes."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Columns under new names, chosen by their names in ``df``."""
    return plain(df).select(*[F.col(f"c{position(df, old)}").alias(new) for new, old in names.items()])


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns of these names, in any case: they are about to be added."""
    gone = {n.lower() for n in names}
    keep = [i for i, c in enumerate(df.columns) if c.lower() not in gone]
    return plain(df).select(*[f"c{i}" for i in keep]).toDF(*[df.columns[i] for i in keep])


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of rows that hold about ``limit`` bytes of text each, at
    least one row; bounds what is worked on at once, whatever the texts' lengths."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i - start
            start, held = i, 0
        held += int(size)
    if start < len(texts):
        yield start, len(texts) - start


def concat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the ranges ``starts[i] .. starts[i] + lengths[i]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, int(starts.max(initial=0))) < 1 << 30 else np.int64
    out = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


def lookup(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per key, stored, and says in
    ``weight`` how many rows have the key.  Keys with more than 1 / ``HOT_SHARE`` of these
    rows, so fewer than ``HOT_SHARE`` keys, are broadcast; the others are shuffled.  A table
    with no other column only filters."""
    total = table.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT_SHARE > total
    found = table.where(hot).drop(weight)
    marked = rows.join(F.broadcast(found.select(key, F.lit(True).alias("_hot"))), key, "left")
    if found.columns == [key]:
        others = marked.where("_hot IS NULL").join(table.where(~hot).select(key), key, "left_semi")
        return marked.where("_hot").unionByName(others).drop("_hot")
    return (
        marked.where("_hot")
        .drop("_hot")
        .join(F.broadcast(found), key)
        .unionByName(marked.where("_hot IS NULL").drop("_hot").join(table.where(~hot).drop(weight), key))
    )


def least_hashed(rows: DataFrame, by: str, most: int) -> DataFrame:
    """The ``most`` rows of the smallest hashes of each value of ``by``, numbered from 1 in ``turn``.

    ``rows``: by, key, hash; distinct, and ``by`` has few values.  They are counted first, and
    only rows whose hash is below a bound that lets several times ``most`` through are
    ranked, so the rank of a value takes a bounded number of rows, whatever its size.
    """
    counted = rows.groupBy(by).agg(F.count("*").alias("_n"))
    share = F.least(F.lit(1.0), F.lit(4.0 * most + 200) / F.col("_n"))
    bounds = counted.select(F.col(by).alias("_by"), (share * 2.0**64 - 2.0**63).alias("_bound"))
    near = rows.join(F.broadcast(bounds), F.col(by).eqNullSafe(F.col("_by"))).where(F.col("hash") <= F.col("_bound"))
    order = Window.partitionBy(by).orderBy("hash", "key")
    ranked = near.drop("_by", "_bound").withColumn("turn", F.row_number().over(order))
    return ranked.where(F.col("turn") <= most)


class Words(dict):
    """Hash of a word, remembered for a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        value = self[word] = int.from_bytes(digest, "little")
        return value


WORDS = Words()


def shingles(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words (lower case, cut at ASCII white space) of all
    texts, and the text of each.  A shorter text with a word is one run."""
    lower = pa.array([t.lower() for t in texts], pa.large_string())
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(lower))
    coded = split.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    known = np.fromiter(map(WORDS.__getitem__, distinct), np.uint64, len(distinct))
    word = coded.indices.to_numpy()
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    # A text of blanks alone splits into one empty word.
    real = word != distinct.index("") if "" in distinct else np.ones(len(word), bool)
    sizes = np.bincount(np.repeat(np.arange(len(texts)), sizes)[real], minlength=len(texts))
    hashes = known[word[real]]
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(hashes))
    length = np.minimum(width, sizes[owner])
    value = np.full(len(hashes), 0x243F6A8885A308D3, np.uint64)
    for i in range(width):
        mixed = (value ^ np.roll(hashes, -i)) * np.uint64(0x9FB21C651E98DF25)
        value = np.where(length > i, mixed ^ (mixed >> np.uint64(31)), value)
    whole = left >= length
    return value[whole], owner[whole]


def weighted(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, value) in this order: values, owners, and how often each occurs."""
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return value[at], owner[at], np.diff(np.append(at, len(new)))
