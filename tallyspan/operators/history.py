"""State history: entity rows and change rows as one SCD-2 table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.operators.dedup import latest_per_key
from tallyspan.schemas import INITIAL_STATE_ID

STATE_COLUMNS = ["license_id", "date", "renewable", "price", "type", "id"]
ATTRIBUTES = ["renewable", "price", "type"]


def stage_initial(initial: DataFrame) -> DataFrame:
    """Entity table in the names of the state history."""
    return initial.select(
        F.col("id").alias("license_id"),
        F.col("creation_date").cast("date").alias("creation_date"),
        "renewable",
        "price",
        "type",
    )


def stage_changes(changes: DataFrame) -> DataFrame:
    """One change per licence and day: the highest id wins."""
    daily = changes.withColumn("date", F.col("date").cast("date")).select(*STATE_COLUMNS)
    return latest_per_key(daily, ["license_id", "date"], [F.col("id").desc()])


def initial_states(initial: DataFrame) -> DataFrame:
    """Entity rows as states on their creation date."""
    return stage_initial(initial).select(
        "license_id",
        F.col("creation_date").alias("date"),
        *ATTRIBUTES,
        F.lit(INITIAL_STATE_ID).cast("long").alias("id"),
    )


def initial_not_superseded(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """Initial states without a change of the same licence on the same day."""
    changed_days = changes.select("license_id", F.col("date").cast("date").alias("date")).distinct()
    return initial_states(initial).join(changed_days, ["license_id", "date"], "left_anti")


def state_log(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """State history plus ``has_initial``: does an entity row start on that day?

    Changes and entity rows are unioned and reduced to one row per licence and day
    in one aggregation, in which any change beats the entity row and a higher id
    beats a lower one.  The maximum is taken before and after the shuffle, so a hot
    licence sends at most one row per day from each map task.
    """
    daily = changes.selectExpr(
        "license_id", "date(date) AS date", "false AS is_initial", "id", "renewable", "price", "type"
    )
    created = initial.selectExpr(
        "id AS license_id",
        "date(creation_date) AS date",
        "true AS is_initial",
        f"{INITIAL_STATE_ID}L AS id",
        "renewable",
        "price",
        "type",
    )
    newest = "max(struct(NOT is_initial AS is_change, id, renewable, price, type)) AS s"
    return (
        daily.union(created)
        .groupBy("license_id", "date")
        .agg(F.expr(newest), F.expr("bool_or(is_initial) AS has_initial"))
        .selectExpr("license_id", "date", "s.renewable", "s.price", "s.type", "s.id", "has_initial")
    )


def state_history(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """One row per licence and effective date."""
    return state_log(initial, changes).select(*STATE_COLUMNS)


def state_intervals(
    initial: DataFrame, changes: DataFrame, fill: str = "row", keep_hidden: bool = False
) -> DataFrame:
    """Validity intervals ``[valid_from, valid_to)`` of known licences.

    ``valid_to`` is NULL for the state in force.  A licence becomes visible on its
    earliest creation date; older changes and licences without an entity row give
    nothing.  After ``state_log`` a licence has at most one row per calendar day,
    which bounds the group that a window task holds.

    ``fill="row"`` takes each state as it is and drops one whose ``renewable`` is
    NULL, after it has ended the state before it.  ``fill="column"`` carries the
    last known value of each attribute forward.

    ``keep_hidden`` keeps the states that are not visible, with a flag ``is_visible``
    and nothing but their day, which counts for the calendar.
    """
    if fill not in ("row", "column"):
        raise ValueError(f"fill must be 'row' or 'column', not {fill!r}")
    by_day = "OVER (PARTITION BY license_id ORDER BY valid_from)"
    so_far = "OVER (PARTITION BY license_id ORDER BY valid_from ROWS UNBOUNDED PRECEDING)"
    log = state_log(initial, changes).withColumnRenamed("date", "valid_from").where("valid_from IS NOT NULL")
    if not keep_hidden:
        log = log.where("license_id IS NOT NULL")
    placed = log.selectExpr(
        "license_id",
        "valid_from",
        f"lead(valid_from) {by_day} AS valid_to",
        *ATTRIBUTES,
        f"license_id IS NOT NULL AND max(has_initial) {so_far} AS is_created",
    )
    shown = "is_created AND renewable IS NOT NULL"
    if fill == "column":
        shown = "is_created"
        filled = [f"last(if(is_created, {c}, NULL), true) {so_far} AS {c}" for c in ATTRIBUTES]
        placed = placed.selectExpr("license_id", "valid_from", "valid_to", *filled, "is_created")
    if not keep_hidden:
        return placed.where(shown).drop("is_created")
    kept = [f"if({shown}, {c}, NULL) AS {c}" for c in ("valid_to", *ATTRIBUTES)]
    return placed.selectExpr("license_id", "valid_from", *kept, f"{shown} AS is_visible")


def activation_flags(states: DataFrame) -> DataFrame:
    """Add 0/1 columns ``activated`` and ``deactivated`` by comparing each state with
    the one before it; the first active state of a licence is an activation."""
    before = F.lag("renewable").over(Window.partitionBy("license_id").orderBy("date"))
    was_active = F.coalesce(before, F.lit(False))
    now_active = F.coalesce("renewable", F.lit(False))
    return states.withColumns(
        {
            "activated": (now_active & ~was_active).cast("long"),
            "deactivated": (~now_active & was_active).cast("long"),
        }
    )
