"""Row positions in one total order, and prefix scans inside a key, without a task
that holds a whole table or a whole key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.session import store_and_reload

SLOT_BITS = 33  # monotonically_increasing_id keeps the row position in its low bits
SEGMENT_WIDTH = 1_000_000
HISTOGRAM_BINS = 4096


def with_row_index(df: DataFrame, order: list[Column], name: str = "row_index") -> DataFrame:
    """0-based position of every row in ``order``, which must be total.

    The rows are range-partitioned and sorted once and stored in the shared folder,
    so that partition and position stay what they were.  Only the row counts of the
    sorted partitions (one row each) are summed in one place and broadcast.
    """
    slots = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id())
    stored = store_and_reload(slots, "sorted").withColumn("_part", F.shiftright("_slot", SLOT_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    position = F.col("_slot").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    return (
        stored.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + position)
        .drop("_part", "_slot", "_start")
    )


def smallest_cut(df: DataFrame, value: str, count: int, low: int, high: int, bins: int = HISTOGRAM_BINS) -> tuple[int, int]:
    """(cut, ties): the ``count`` smallest values are those below ``cut`` and ``ties`` of those
    equal to it.  ``value``, an expression, is a whole number in [low, high).

    Nothing is sorted or moved.  Values are counted in equal bins, at most ``bins`` of them, and the bin in which
    the count is reached is cut into bins again until it is used up or holds one value: one
    aggregation for each time that the range shrinks ``bins``-fold.
    """
    if count <= 0:
        return low, 0
    while True:
        step = -(-(high - low) // bins)
        inside = df.selectExpr(f"{value} AS _v").where(f"_v >= {low}BD AND _v < {high}BD")
        counted = inside.groupBy(F.expr(f"cast((_v - {low}BD) div {step}BD AS int)").alias("bin")).count().collect()
        for number, rows in sorted(tuple(r) for r in counted):
            if rows >= count:
                break
            count -= rows
        else:
            raise ValueError("fewer values than asked for")
        low, high = low + number * step, min(high, low + (number + 1) * step)
        if rows == count:
            return high, 0
        if high - low == 1:
            return low, count


def assign_batches(df: DataFrame, size: int, day: str, sequence: str, width: int = SEGMENT_WIDTH) -> DataFrame:
    """Add ``batch_id``: consecutive batches of ``size`` rows in the order of ``day`` and then of
    ``sequence``, a non-negative integer that is unique within a day.

    A day is cut into segments of ``width`` sequence numbers, and a row's position is the rows
    of the days before, plus those of the segments before in its day, plus its number in its
    segment.  Rows meet only in their segment; nothing is stored.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    cut = df.withColumn("_segment", F.floor(F.col(sequence) / width))
    earlier = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    in_day = Window.partitionBy("_day").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(F.col(day).alias("_day"), F.col("_segment").alias("_at")).count()
    zero = F.lit(0).cast("long")
    segments = counts.withColumn("_in_day", F.coalesce(F.sum("count").over(in_day), zero)).drop("count")
    days = counts.groupBy("_day").agg(F.sum("count").alias("count"))
    days = days.select(F.col("_day").alias("_date"), F.coalesce(F.sum("count").over(earlier), zero).alias("_before"))
    starts = segments.join(days, F.col("_day").eqNullSafe(F.col("_date"))).select(
        "_day", "_at", (F.col("_in_day") + F.col("_before")).alias("_start")
    )
    inside = Window.partitionBy(day, "_segment").orderBy(sequence)
    numbered = cut.withColumn("_number", F.row_number().over(inside))
    placed = numbered.join(starts, F.col(day).eqNullSafe(F.col("_day")) & F.col("_segment").eqNullSafe(F.col("_at")))
    position = F.col("_start") + F.col("_number") - 1
    return placed.withColumn("batch_id", F.floor(position / size)).select(*df.columns, "batch_id")


def toggle_states(
    log: DataFrame,
    key: str,
    sequence: str,
    label: str,
    prefix: str = "RENEW",
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """Read a log of labels as states: add ``main_type`` and ``is_active``.

    A label that starts with ``prefix`` flips the active flag, which is on at first,
    and keeps the type; any other label sets the type.  ``sequence`` is a non-negative
    integer, unique per key, such as the position in the log.  The log of a key is cut
    into segments of ``width`` sequence numbers: each segment is one group of at most
    ``width`` rows, and only one summary row per segment takes part in the scan over the
    whole key.  For widely spaced numbers take a larger ``width``.
    """
    flips = F.col(label).startswith(prefix)
    cut = log.withColumns(
        {
            "_segment": F.floor(F.col(sequence) / width),
            "_flip": F.coalesce(flips.cast("long"), F.lit(0).cast("long")),
            "_type": F.when(~flips, F.col(label)),
        }
    )
    earlier = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        cut.groupBy(F.col(key).alias("_key"), F.col("_segment").alias("_at"))
        .agg(
            F.sum("_flip").alias("_flips"),
            F.max(F.when(F.col("_type").isNotNull(), F.struct(sequence, "_type")))["_type"].alias("_last"),
        )
        .select(
            "_key",
            "_at",
            F.coalesce(F.sum("_flips").over(earlier), F.lit(0)).alias("_flips_before"),
            F.last("_last", ignorenulls=True).over(earlier).alias("_type_before"),
        )
    )
    inside = (
        Window.partitionBy(key, "_segment")
        .orderBy(sequence)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        cut.join(carry, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_segment") == F.col("_at")))
        .withColumns(
            {
                "main_type": F.coalesce(F.last("_type", ignorenulls=True).over(inside), "_type_before"),
                "is_active": (F.col("_flips_before") + F.sum("_flip").over(inside)) % 2 == 0,
            }
        )
        .select(*log.columns, "main_type", "is_active")
    )
