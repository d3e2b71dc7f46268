"""Daily metrics from additive deltas.

A state interval adds its licence on ``valid_from`` and takes it away on
``valid_to``.  Summed per (date, type) these deltas are a table of at most days x
types rows, and its running sum per type is the daily level.  The work grows with
the number of states, not with days x licences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.columns import active_value
from tallyspan.operators.dedup import latest_per_key
from tallyspan.operators.spine import densify, with_bounds

# members: licences of the type; priced: those whose price enters the sum.
MEASURES = ["members", "active", "inactive", "price", "priced"]
ADDITIVE = [*MEASURES, "starts", "states"]


def interval_deltas(intervals: DataFrame, sign: str = "1L") -> DataFrame:
    """Deltas per (date, type); ``starts`` counts the intervals that begin there, and
    ``states`` all states, so also the hidden ones, if kept, which have no type and
    count nowhere else: the calendar runs over the days with a state.

    ``sign`` is an expression of 1 or -1 per interval.
    """
    shown = "is_visible" if "is_visible" in intervals.columns else "true"
    measured = intervals.selectExpr(
        "type",
        "valid_from",
        "valid_to",
        f"{sign} AS sign",
        f"if({shown}, 1L, 0L) * {sign} AS members",
        f"if(renewable <=> true, 1L, 0L) * {sign} AS active",
        f"if(renewable <=> false, 1L, 0L) * {sign} AS inactive",
        f"coalesce(if(renewable, price, 0), 0) * {sign} AS price",
        f"if({shown} AND NOT (renewable <=> true AND price IS NULL), 1L, 0L) * {sign} AS priced",
    )
    began = ", ".join(MEASURES)
    ended = ", ".join(f"-{m}" for m in MEASURES)
    edges = measured.selectExpr(
        "type",
        f"stack(2, valid_from, sign, members, {began}, valid_to, 0L, 0L, {ended}) AS (date, states, starts, {began})",
    )
    return _sum_deltas(edges.where("date IS NOT NULL"))


def _sum_deltas(rows: DataFrame) -> DataFrame:
    sums = [F.expr(f"sum({m}) AS {m}") for m in ADDITIVE]
    return rows.groupBy("date", "type").agg(*sums)


def unplaced_days(changes: DataFrame, sign: int = 1) -> DataFrame:
    """Deltas of changes without a licence: each counts, with this sign, for its day in the
    calendar, so that one can be taken back without the others."""
    lost = changes.where("license_id IS NULL AND date IS NOT NULL")
    counted = lost.groupBy(F.col("date").cast("date").alias("date")).agg((sign * F.count("*")).alias("states"))
    zeros = [F.lit(0).cast("long").alias(m) for m in ADDITIVE if m != "states"]
    return counted.select("date", F.lit(None).cast("string").alias("type"), "states", *zeros)


def add_deltas(*parts: DataFrame) -> DataFrame:
    """Sum of delta tables, without the rows that have cancelled out: a correction leaves
    them on days that it has emptied, which may lie outside the calendar now."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return _sum_deltas(merged).where(" OR ".join(f"{m} <> 0" for m in ADDITIVE))


def delta_bounds(deltas: DataFrame) -> DataFrame:
    """First and last day with a state, from deltas with the hidden days.  A day that a
    correction has emptied no longer counts."""
    days = deltas.groupBy("date").agg(F.sum("states").alias("states")).where("states > 0")
    return days.agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))


def daily_levels(deltas: DataFrame, bounds: DataFrame) -> DataFrame:
    """Dense calendar x type levels and day-over-day differences.

    A delta row explodes into the days up to the next delta of its type; the first
    one also covers the days before it with zeros.  The window sees one row per day
    and type, and there is neither a grid nor a join.
    """
    by_day = "OVER (PARTITION BY type ORDER BY date)"
    so_far = "OVER (PARTITION BY type ORDER BY date ROWS UNBOUNDED PRECEDING)"
    steps = deltas.selectExpr(
        "type",
        "date AS step",
        f"lead(date) {by_day} AS next_step",
        f"lag(date) {by_day} AS previous_step",
        "sum(starts) OVER (PARTITION BY type) AS type_starts",
        *[f"sum({m}) {so_far} AS {m}" for m in MEASURES],
        *[f"{m} AS {m}_delta" for m in MEASURES],
    ).where("type_starts > 0")
    days = with_bounds(steps, bounds).selectExpr(
        "*",
        """explode(sequence(if(previous_step IS NULL, least(span.first_day, step), step),
                            coalesce(date_sub(next_step, 1), span.last_day))) AS date""",
    )
    return days.selectExpr(
        "date",
        "type",
        *[f"if(date >= step, {m}, 0L) AS {m}" for m in MEASURES],
        *[f"if(date = step AND date <> span.first_day, {m}_delta, 0L) AS {m}_diff" for m in MEASURES],
    )


def mart_from_deltas(deltas: DataFrame, bounds: DataFrame) -> DataFrame:
    """Daily metrics table.  A NULL type stays on the axis with zeros."""
    named = {
        "active_license_count": "active",
        "active_license_price": "price",
        "inactive_license_count": "inactive",
        "daily_active_diff": "active_diff",
        "daily_price_diff": "price_diff",
        "daily_inactive_diff": "inactive_diff",
    }
    columns = [f"if(type IS NOT NULL, {source}, 0L) AS {name}" for name, source in named.items()]
    return daily_levels(deltas, bounds).selectExpr("date", "type", *columns)


def sparse_metrics(deltas: DataFrame, bounds: DataFrame) -> DataFrame:
    """Counts and price only for the (date, type) pairs that have a licence.

    The price is NULL if every licence of the pair is active without a price.
    """
    return (
        daily_levels(deltas, bounds)
        .where("members > 0")
        .selectExpr(
            "date",
            "type",
            "active AS active_license_count",
            "inactive AS inactive_license_count",
            "if(priced > 0, price, NULL) AS active_license_price",
        )
    )


def day_over_day(df: DataFrame, by: list[str], measures: dict[str, str]) -> DataFrame:
    """Add ``measures[c]`` = value of c minus its value on the row before, 0 first."""
    by_day = Window.partitionBy(*by).orderBy("date")
    return df.withColumns(
        {name: F.coalesce(F.col(c) - F.lag(c).over(by_day), F.lit(0).cast("long")) for c, name in measures.items()}
    )


def panel_counts(panel: DataFrame, bounds: DataFrame, newest_first: list[Column]) -> DataFrame:
    """Counts and differences of a given panel; the newest row of a licence-day counts."""
    current = latest_per_key(panel, ["date", "license_id"], newest_first)
    counts = current.groupBy("date", "type").agg(
        F.count_if("renewable").alias("active_license_count"),
        F.count_if(~F.col("renewable")).alias("inactive_license_count"),
    )
    dense = densify(counts, ["type"], bounds, {"active_license_count": 0, "inactive_license_count": 0})
    return day_over_day(
        dense,
        ["type"],
        {"active_license_count": "daily_active_diff", "inactive_license_count": "daily_inactive_diff"},
    )


def panel_price(panel: DataFrame, bounds: DataFrame) -> DataFrame:
    """Active price of a given panel, every row counted, dense over the calendar."""
    value = active_value(F.col("renewable"), F.col("price"))
    price = panel.groupBy("date", "type").agg(F.sum(value).alias("active_license_price"))
    return densify(price, ["type"], bounds, {"active_license_price": 0})


def daily_events(states: DataFrame, bounds: DataFrame) -> DataFrame:
    """Activations and deactivations per (date, type), dense over the calendar."""
    events = states.groupBy("date", "type").agg(
        F.sum("activated").alias("activated_licenses"), F.sum("deactivated").alias("deactivated_licenses")
    )
    return densify(events, ["type"], bounds, {"activated_licenses": 0, "deactivated_licenses": 0})
