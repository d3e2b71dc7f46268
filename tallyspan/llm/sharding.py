"""Shards of equal bytes, equal texts together, by Karmarkar-Karp differencing.

The items are the groups of equal texts, each with the sum of its rows' sizes.  Groups
that hold more than 1 / ``HEAVY`` of all bytes or rows (at most 2 x ``HEAVY`` of them) go
to the last step as they are.  The others are dealt by a hash into batches of a bounded
number, and differencing divides each batch into bundles of nearly equal bytes; bundles
are bundled again while there are more than one task should hold.  The last step divides
bundles and heavy groups into the shards.  A heavy group is therefore offset by the
bundles, however large it is; a group that alone exceeds a shard's share stays whole.

No text is shuffled, only digests, sizes and ids.  Heavy groups are looked up from a
broadcast of that bounded size, so no key of the remaining join is hot.

Defined cases: a null text is an empty text; rows with the same id or a null id are rows
like others; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import pick
from tallyspan.llm.differencing import difference
from tallyspan.session import store_and_reload

SHARDS = 8
HEAVY = 4096
BATCH = 50_000
BUNDLES = 64
TOP = 65_536
SLOT_ROWS = 20_000


def _bundled(items: DataFrame, count: int) -> DataFrame:
    """(item, bytes, bundle): differencing inside batches of about ``BATCH`` items."""
    batches = max(1, -(-count // BATCH))

    def divide(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("item", ignore_index=True)
        local = difference(part["bytes"].to_numpy(), BUNDLES, balanced=True)
        part["bundle"] = part["_batch"] * BUNDLES + local
        return part[["item", "bytes", "bundle"]]

    hashed = items.withColumn("_batch", F.pmod(F.xxhash64("item"), F.lit(batches)))
    kind = items.schema["item"].dataType.simpleString()
    return hashed.groupBy("_batch").applyInPandas(divide, f"item {kind}, bytes bigint, bundle bigint")


def shard_of_groups(groups: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """(item, shard) of the heavy and of the other groups; ``groups``: item, bytes, rows, stored."""
    total, rows, count = groups.agg(F.sum("bytes"), F.sum("rows"), F.count("*")).first()
    heavy = (F.col("bytes") * HEAVY > (total or 0)) | (F.col("rows") * HEAVY > (rows or 0))
    light = groups.where(~heavy).select("item", "bytes")
    levels = [store_and_reload(_bundled(light, count), "bundles")]
    bundles = levels[0].groupBy(F.col("bundle").alias("item")).agg(F.sum("bytes").alias("bytes"))
    while (count := -(-count // BATCH) * BUNDLES) > TOP:
        levels.append(store_and_reload(_bundled(bundles, count), "bundles"))
        bundles = levels[-1].groupBy(F.col("bundle").alias("item")).agg(F.sum("bytes").alias("bytes"))

    def divide(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["heavy", "bundle"], ignore_index=True)
        part["shard"] = difference(part["bytes"].to_numpy(), shards).astype(np.int32)
        return part[["bundle", "heavy", "shard"]]

    last = bundles.select(F.col("item").alias("bundle"), F.lit(None).cast("binary").alias("heavy"), "bytes").unionByName(
        groups.where(heavy).select(F.lit(None).cast("bigint").alias("bundle"), F.col("item").alias("heavy"), "bytes")
    )
    top = store_and_reload(
        last.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(divide, "bundle bigint, heavy binary, shard int"), "shards"
    )
    at = top.where("bundle IS NOT NULL").select("bundle", "shard")
    for level in reversed(levels[1:]):
        at = level.join(at, "bundle").select(F.col("item").alias("bundle"), "shard")
    bounded = F.broadcast(at) if len(levels) == 1 else at  # at most TOP rows
    return top.where("heavy IS NOT NULL").select(F.col("heavy").alias("item"), "shard"), levels[0].join(
        bounded, "bundle"
    ).select("item", "shard")


def shard(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per input row: key, size, text_crc32, shard, slot (gapless in the shard)."""
    content = F.coalesce("text", F.lit(""))
    rows = store_and_reload(
        pick(df, key=key, text=text).select(
            "key",
            (F.octet_length(content) + 1).cast("long").alias("size"),
            F.crc32(content.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(content.cast("binary"), 256)).alias("item"),
        ),
        "sizes",
    )
    groups = store_and_reload(
        rows.groupBy("item").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "groups"
    )
    heavy, light = shard_of_groups(groups, shards)
    marked = rows.join(F.broadcast(heavy.withColumnRenamed("shard", "_shard")), "item", "left")
    placed = marked.where("_shard IS NOT NULL").withColumnRenamed("_shard", "shard").unionByName(
        marked.where("_shard IS NULL").drop("_shard").join(light, "item")
    )
    return with_slots(placed.drop("item")).withColumnRenamed("key", key)


def _bucketed(placed: DataFrame) -> DataFrame:
    """Adds ``_row``, a stored number, and ``_bucket``, by its hash: rows equal in all else are spread too."""
    placed = store_and_reload(placed.withColumn("_row", F.monotonically_increasing_id()), "placed")
    buckets = max(64, -(-placed.count() // SLOT_ROWS))
    return placed.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)))


def with_slots(placed: DataFrame) -> DataFrame:
    """Adds ``slot``: positions from 0 inside each shard.  A shard's rows are numbered in
    buckets of a bounded number of rows; only the buckets' counts are summed per shard."""
    placed = _bucketed(placed)
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        placed.groupBy("shard", "_bucket")
        .count()
        .select("shard", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    )
    inside = Window.partitionBy("shard", "_bucket").orderBy("_row")
    return (
        placed.withColumn("_number", F.row_number().over(inside))
        .join(bases, ["shard", "_bucket"])
        .withColumn("slot", (F.col("_base") + F.col("_number") - 1).cast("long"))
        .drop("_row", "_bucket", "_number", "_base")
    )


def op10(documents: DataFrame) -> DataFrame:
    """The rows of the contract, under the law ``bytes``."""
    return shard(documents).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
