"""Packing token sequences into windows of a fixed capacity.

A document is cut into pieces: whole windows as long as it fills them, then pieces of at
most ``piece`` tokens of what is left.  The left-over pieces are dealt by a hash into
groups of a bounded number of tokens; each group is divided into windows by multiway
Karmarkar-Karp differencing.  A partial partition is a vector of window sums; the two
partitions of the largest spread are merged, the fullest windows of one with the emptiest
of the other, until one is left.  If a window of the result exceeds the capacity, the
number of windows rises and the group is divided again.

A task holds one batch of texts or one group of pieces, whatever the size of the input.
Pieces carry their ids' checksum, not the ids.

Defined cases: a null or empty text is the closing id alone; equal rows are packed each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.llm.common import SLICE_BYTES, begin, pick, text_slices, tidy
from tallyspan.llm.differencing import difference
from tallyspan.llm.wordsplit import forget, word_ids
from tallyspan.session import store_and_reload

CAPACITY = 2048
PIECE = 512
GROUP_TOKENS = 512 * CAPACITY
CLOSING_ID = 1
CACHE_ENTRIES = 400_000
BLOCK_GROUPS = 4096


def windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each size (none above ``capacity``), no window over the capacity."""
    if len(sizes) == 0:
        return np.zeros(0, np.int64)
    count = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        parts = difference(sizes, count, balanced=True)
        if np.bincount(parts, weights=sizes, minlength=count).max() <= capacity:
            return parts
        count += 1


def token_pieces(
    df: DataFrame,
    path: str,
    key: str,
    text: str = "text",
    capacity: int = CAPACITY,
    piece: int = PIECE,
    cache: int = CACHE_ENTRIES,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, whole) per piece, in each row's order."""
    kept = pick(df, key=key, text=text)
    schema = T.StructType(
        [
            kept.schema[0],
            *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")],
            T.StructField("whole", T.BooleanType()),
        ]
    )
    closing = np.array([CLOSING_ID], np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("packing", forget)
        encoder = word_ids(path, cache)
        for batch in batches:
            tidy()
            for at, length in text_slices(batch.column(1), slice_bytes):
                ids, starts = encoder.encode(batch.column(1).slice(at, length))
                # The closing id goes behind each text.
                ids = np.insert(ids, starts[1:], closing).astype("<u4")
                starts = starts + np.arange(length + 1)
                totals = np.diff(starts)
                full = totals // capacity
                rest = totals - full * capacity
                counts = full + -(-rest // piece)
                row = np.repeat(np.arange(length), counts)
                number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                whole = number < full[row]
                first = np.where(whole, number * capacity, full[row] * capacity + (number - full[row]) * piece)
                size = np.where(whole, capacity, np.minimum(piece, totals[row] - first))
                raw = memoryview(ids).cast("B")
                low = 4 * (starts[row] + first)
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(low.tolist(), (low + 4 * size).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, length).take(pa.array(row)),
                        *[pa.array(x, pa.int64()) for x in (first, size, crc, totals[row])],
                        pa.array(whole),
                    ],
                    names=schema.names,
                )

    return kept.mapInArrow(run, schema)


def pack(
    df: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    piece: int = PIECE,
    group_tokens: int = GROUP_TOKENS,
    cache: int = CACHE_ENTRIES,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The pieces are stored once (a few dozen bytes each), so that their groups and windows
    stay what they were when an executor is lost.  Sequence ids are positions in (group,
    window); the window counts of the groups are summed in blocks, and only those of the blocks in one place.  ``cache`` (words
    remembered) and ``slice_bytes`` (text whose ids are held at once) bound a worker's memory
    and change no result.
    """
    pieces = store_and_reload(
        token_pieces(df, path, key, text, capacity, piece, cache, slice_bytes).withColumn("_row", F.monotonically_increasing_id()),
        "pieces",
    )
    left = pieces.where(~F.col("whole"))
    tokens = left.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // group_tokens))
    schema = T.StructType(
        [f for f in pieces.schema.fields]
        + [T.StructField("_group", T.LongType()), T.StructField("_window", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def divide(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_row", ignore_index=True)
        part["_window"] = windows(part["length"].to_numpy(), capacity)
        part["offset"] = part.groupby("_window")["length"].cumsum() - part["length"]
        return part[schema.names]

    hashed = left.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    divided = store_and_reload(hashed.groupBy("_group").applyInPandas(divide, schema), "windows")
    # Whole windows are numbered inside blocks of rows by the same scheme, in groups of
    # their own behind the others.
    blocks = max(1, -(-pieces.where("whole").count() // 100_000))
    block = F.lit(groups) + F.pmod(F.xxhash64("_row"), F.lit(blocks))
    whole = pieces.where("whole").withColumn("_group", block)
    whole = whole.withColumns(
        {
            "_window": F.row_number().over(Window.partitionBy("_group").orderBy("_row")).cast("long") - 1,
            "offset": F.lit(0).cast("long"),
        }
    )
    rows = divided.unionByName(whole)
    counts = rows.groupBy("_group").agg((F.max("_window") + 1).alias("_count"))
    # Summed inside blocks of groups, and then over the blocks.
    counts = counts.withColumn("_block", F.floor(F.col("_group") / BLOCK_GROUPS))
    inside = Window.partitionBy("_block").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("_block").agg(F.sum("_count").alias("_sum"))
    blocks = blocks.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    counts = counts.withColumn("_inside", F.coalesce(F.sum("_count").over(inside), F.lit(0)))
    bases = counts.join(blocks, "_block").select("_group", (F.col("_start") + F.col("_inside")).alias("_base"))
    return rows.join(bases, "_group").select(
        F.col("key").alias(key),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("_base") + F.col("_window")).alias("sequence_id"),
        "offset",
    )
