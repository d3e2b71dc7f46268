"""One row per key, always under an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``newest_first``.

    ``row_number() = 1`` gets a group limit before the shuffle, so a map task
    sends at most one row per key, however many copies the key has.  Columns that
    are left break ties, which makes the result independent of the input order.
    """
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    order = Window.partitionBy(*keys).orderBy(*newest_first, *rest)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def flag_first_occurrence(df: DataFrame, key: str, position: str, flag: str = "is_first") -> DataFrame:
    """Mark the row of each key that has the lowest ``position``.

    ``position`` must be unique within a key.  The lowest position per key is a
    plain aggregate (partial on the map side).  It is joined back on the pair
    (key, position), so the copies of one key spread over all tasks.
    """
    first = (
        df.groupBy(F.col(key).alias("_key"))
        .agg(F.min(position).alias("_position"))
        .withColumn("_hit", F.lit(True))
    )
    return (
        df.join(first, F.col(key).eqNullSafe(F.col("_key")) & (F.col(position) == F.col("_position")), "left")
        .withColumn(flag, F.coalesce("_hit", F.lit(False)))
        .drop("_key", "_position", "_hit")
    )
