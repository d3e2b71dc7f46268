"""Joins of a long table with a table of unique keys, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 10_000_000
SAMPLED_ROWS = 2000  # rows that a sample should hold of a key that is just hot
BROADCAST_KEYS = 1_000_000


def hot_safe_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    salt_by: str,
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``facts.join(lookup, keys, how)`` for left outer, semi and anti joins.

    ``lookup`` has one row per key.  A key with more than ``hot_rows`` facts is cut by
    a hash of ``salt_by`` into pieces of about that size, and its lookup row is repeated
    per piece; every other key has one piece.  Hot keys are found in a sample: how a key is
    cut never changes the answer.  About rows / hot_rows keys can be hot, which bounds the
    broadcast.

    A plain join is not enough: where ``lookup`` is already partitioned by the key, AQE
    finds no shuffle on that side and does not split the hot partition.
    """
    fraction = min(1.0, SAMPLED_ROWS / hot_rows)
    seen = facts.sample(fraction=fraction, seed=1) if fraction < 1 else facts
    rows = F.col("count") / fraction
    pieces = (
        seen.groupBy(*[F.col(k).alias(f"_{k}") for k in keys])
        .count()
        .where(rows > hot_rows)
        .select(*[f"_{k}" for k in keys], F.ceil(rows / hot_rows).alias("_pieces"))
    )

    def cut(df: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        counted = df.join(F.broadcast(pieces), same, "left").drop(*[f"_{k}" for k in keys])
        return counted.withColumn("_pieces", F.coalesce("_pieces", F.lit(1).cast("long")))

    salted = cut(facts).withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.col("_pieces"))).drop("_pieces")
    repeated = cut(lookup).withColumn("_salt", F.explode(F.expr("sequence(0L, _pieces - 1)"))).drop("_pieces")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def rows_of_keys(
    facts: DataFrame, keys: DataFrame, key: str, salt_by: str, max_broadcast: int = BROADCAST_KEYS
) -> DataFrame:
    """Rows of ``facts`` whose ``key`` is in ``keys`` (stored, one row per key).

    Up to ``max_broadcast`` keys are broadcast, so the facts are filtered where they are
    read.  The keys are counted first, and more of them go through ``hot_safe_join``.
    """
    if keys.limit(max_broadcast + 1).count() <= max_broadcast:
        return facts.join(F.broadcast(keys), key, "left_semi")
    return hot_safe_join(facts, keys, [key], salt_by, "left_semi")
