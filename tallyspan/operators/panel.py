"""Daily panel, as-of lookups and per-licence daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.operators.history import ATTRIBUTES, state_intervals
from tallyspan.operators.skew import hot_safe_join
from tallyspan.operators.spine import calendar_bounds, days_between, with_bounds


def daily_states(initial: DataFrame, changes: DataFrame, fill: str = "row") -> DataFrame:
    """One row per licence and day from its creation to the last calendar day.

    Each interval explodes into its own days: no grid and no range join.  Ask for
    it only if the rows themselves are wanted; the metrics do not need it.
    """
    intervals = with_bounds(state_intervals(initial, changes, fill), calendar_bounds(initial, changes))
    days = days_between("valid_from", "coalesce(date_sub(valid_to, 1), span.last_day)")
    return intervals.selectExpr("license_id", f"explode({days}) AS date", "renewable", "type", "price")


def asof_lookup(points: DataFrame, states: DataFrame, point_id: str) -> DataFrame:
    """Add to each point (license_id, date, ...) the state in force on that day.

    The distinct licence-days of the points are merged into the state rows and a
    running ``last`` carries the state forward, so a licence costs at most two rows
    per day there and no pair of point and older state is ever formed.  The answer
    is then joined back on (license_id, date); ``point_id`` cuts up a hot licence-day.
    Points before the first state get NULLs.
    """
    carried = F.struct(F.col("date").alias("state_date"), *ATTRIBUTES)
    known = states.select("license_id", "date", carried.alias("state"), F.lit(False).alias("is_point"))
    asked = (
        points.select("license_id", "date")
        .distinct()
        .withColumn("state", F.lit(None).cast(known.schema["state"].dataType))
        .withColumn("is_point", F.lit(True))
    )
    order = (
        Window.partitionBy("license_id")
        .orderBy("date", "is_point")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        known.unionByName(asked)
        .withColumn("state", F.last("state", ignorenulls=True).over(order))
        .where("is_point")
        .select("license_id", "date", "state.*")
    )
    return hot_safe_join(points, answers, ["license_id", "date"], point_id)


def license_daily_series(states: DataFrame) -> DataFrame:
    """``renewable`` per licence and day, from its own first to its own last state."""
    following = "lead(date) OVER (PARTITION BY license_id ORDER BY date) AS next_date"
    days = days_between("date", "coalesce(date_sub(next_date, 1), date)")
    return states.selectExpr("license_id", "date", "renewable", following).selectExpr(
        "license_id", f"explode({days}) AS date", "renewable"
    )
