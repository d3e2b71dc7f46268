"""Largest-remainder apportionment and row repetition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.ranking import smallest_cut

REPEAT_CHUNK = 100_000
WEIGHT_UNITS = 10**18  # weights are at most 1 and are counted in these units


def apportion(keys: DataFrame, key: str, total: int | Column, alpha: float = 1.5) -> DataFrame:
    """Split ``total`` over positive distinct whole keys by weight ``key ** -alpha``; a total may
    be the scalar of another query.

    Each key gets 1, then the floor of its share of the rest, and what is left goes
    one by one to the largest fractions, ties to the lower key.  Weights become whole
    numbers first; their sum, the floors and the remainders that stand for the fractions are
    exact, so the order in which rows are added up never shows.

    The smallest fraction that still gets one more is found from counts, and so is
    the last key among ties, so no row is sorted, stored or moved.
    """
    if isinstance(total, Column):
        total = keys.sparkSession.range(1).select(total).first()[0]
    units = F.pow(F.col(key).cast("double"), F.lit(-float(alpha))) * F.lit(float(WEIGHT_UNITS))
    weighted = keys.select(key).withColumn("_weight", F.floor(units).cast("decimal(19,0)"))
    whole = weighted.agg(F.count("*"), F.sum("_weight").cast("decimal(38,0)"), F.min(key), F.max(key)).first()
    n, weight = whole[0], int(whole[1] or 0)
    if total < n:
        raise ValueError("total must be at least the number of keys")
    if not n:
        return weighted.select(key, F.lit(1).cast("long").alias("allotted"))
    part = f"_weight * {total - n}BD"
    floors = weighted.selectExpr(
        f"`{key}`", f"cast({part} div {weight}BD AS bigint) AS _floor", f"cast({part} % {weight}BD AS decimal(38,0)) AS _fraction"
    )
    left = total - n - (floors.agg(F.sum("_floor")).first()[0] or 0)
    # The largest fractions are the smallest differences from the whole weight.
    missing = f"{weight}BD - _fraction"
    cut, ties = smallest_cut(floors, missing, left, 0, weight + 1)
    last, _ = smallest_cut(
        floors.where(f"{missing} = {cut}BD"), f"cast(`{key}` AS decimal(38,0))", ties, int(whole[2]), int(whole[3]) + 1
    )
    extra = f"if({missing} < {cut}BD OR ({missing} = {cut}BD AND `{key}` < {last}), 1L, 0L)"
    if not ties:
        extra = f"if({missing} < {cut}BD, 1L, 0L)"
    return floors.selectExpr(f"`{key}`", f"1L + _floor + {extra} AS allotted")


def repeat_rows(df: DataFrame, times: str, chunk: int = REPEAT_CHUNK) -> DataFrame:
    """Each row ``times`` times, numbered from 1 in ``copy``; rows with 0 vanish.

    A count above ``chunk`` is cut into chunks which are spread over the tasks, so one row
    with a huge count does not expand inside a single task.  Only these rows are shuffled.
    """
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col(times).cast("long")))
    small = df.where((F.col(times) > 0) & (F.col(times) <= chunk)).select("*", copies.alias("copy"))
    last_chunk = F.floor((F.col(times) - 1) / chunk)
    pieces = df.where(F.col(times) > chunk).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk))
    )
    first = F.col("_chunk") * chunk + 1
    last = F.least(F.col(times), (F.col("_chunk") + 1) * chunk)
    spread = pieces.repartition(*df.columns, "_chunk")
    return small.unionByName(spread.select(*df.columns, F.explode(F.sequence(first, last)).alias("copy")))
