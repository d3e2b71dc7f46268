"""End-to-end plans from the two input tables to the daily metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.operators import history, metrics, panel, spine


def license_metrics(initial: DataFrame, changes: DataFrame, fill: str = "row") -> DataFrame:
    """Dense daily metrics per licence type with day-over-day differences.

    Shuffles: states by (licence, day), states by licence, deltas by (day, type),
    days x types by type.
    """
    deltas = metrics.interval_deltas(history.state_intervals(initial, changes, fill))
    return metrics.mart_from_deltas(deltas, spine.calendar_bounds(initial, changes))


def daily_metrics(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """Counts and price of the (date, type) pairs that have a licence."""
    deltas = metrics.interval_deltas(history.state_intervals(initial, changes))
    return metrics.sparse_metrics(deltas, spine.calendar_bounds(initial, changes))


def daily_price(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """Active price per (date, type), dense."""
    return license_metrics(initial, changes).select("date", "type", "active_license_price")


def license_types(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """Types that some licence has on some day."""
    return history.state_intervals(initial, changes).select("type").distinct()


def date_type_grid(initial: DataFrame, changes: DataFrame) -> DataFrame:
    return spine.calendar_grid(license_types(initial, changes), spine.calendar_bounds(initial, changes))


def daily_events(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """Activations and deactivations derived from the state history."""
    flagged = history.activation_flags(history.state_history(initial, changes))
    return metrics.daily_events(flagged, spine.calendar_bounds(initial, changes))


def ordered(mart: DataFrame) -> DataFrame:
    """Display order of the metrics table, which has days x types rows."""
    return mart.orderBy(F.col("date"), F.col("type"))


def register_views(spark: SparkSession, initial: DataFrame, changes: DataFrame) -> list[str]:
    """Name every layer as a temporary view; nothing is computed."""
    bounds = spine.calendar_bounds(initial, changes)
    layers = {
        "stg_initial_licenses": history.stage_initial(initial),
        "stg_license_changes": history.stage_changes(changes),
        "inter_state_licenses": history.state_history(initial, changes),
        "inter_licenses_calendar": spine.calendar(bounds).withColumnRenamed("date", "date_day"),
        "inter_licenses_daily_states": panel.daily_states(initial, changes),
        "inter_license_daily_metrics": daily_metrics(initial, changes),
        "mart_license_metrics": license_metrics(initial, changes),
    }
    for name, frame in layers.items():
        frame.createOrReplaceTempView(name)
    return list(layers)
