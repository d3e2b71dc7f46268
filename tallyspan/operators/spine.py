"""Date spine, date x type grid and densifying."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar_bounds(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """One row (first_day, last_day) over all states.

    Reducing to one state per licence and day loses no date, so the bounds come
    from the date columns of the two inputs without a shuffle of their rows.
    """
    days = changes.selectExpr("date(date) AS day").union(initial.selectExpr("date(creation_date) AS day"))
    return days.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def with_bounds(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Add the one-row bounds as a struct column ``span`` (a scalar subquery)."""
    return df.withColumn("span", bounds.select(F.struct("first_day", "last_day")).scalar())


def days_between(first: str, last: str) -> str:
    """SQL text of the array of days first..last; NULL if last is before first."""
    return f"if({last} >= {first}, sequence({first}, {last}), NULL)"


def calendar(bounds: DataFrame) -> DataFrame:
    return bounds.selectExpr(f"explode({days_between('first_day', 'last_day')}) AS date")


def calendar_grid(keys: DataFrame, bounds: DataFrame) -> DataFrame:
    """Every calendar day for every row of ``keys``, by exploding inside each row."""
    days = days_between("span.first_day", "span.last_day")
    return with_bounds(keys, bounds).selectExpr(f"explode({days}) AS date", *keys.columns)


def densify(df: DataFrame, by: list[str], bounds: DataFrame, fill: dict[str, int]) -> DataFrame:
    """``df``, unique per (date, *by), on the full grid calendar x ``by`` values.

    Gaps and NULLs take their value from ``fill``, and so does a key with a NULL.
    Rows outside the calendar are dropped, but their key keeps its place on the grid.

    Each row explodes into the days from itself to the next row of its key, the first
    one also into the days before it: one window over at most one row per key and
    day, and no second copy of ``df`` for a join with the grid.
    """
    keys = ", ".join(by)
    by_day = f"OVER (PARTITION BY {keys} ORDER BY date)"
    placed = with_bounds(df, bounds).selectExpr(
        *by, "date AS day", *fill, "span", f"lag(date) {by_day} AS previous", f"lead(date) {by_day} AS next",
        f"row_number() {by_day} AS place",
        f"count_if(date BETWEEN span.first_day AND span.last_day) OVER (PARTITION BY {keys}) AS n_inside",
        "coalesce(date BETWEEN span.first_day AND span.last_day, false) AS inside",
    )
    start = "if(inside AND previous >= span.first_day, day, span.first_day)"
    until = "if(inside, least(coalesce(date_sub(next, 1), span.last_day), span.last_day), span.last_day)"
    spread = placed.where("inside OR (n_inside = 0 AND place = 1)").selectExpr(
        "*", f"explode({days_between(start, until)}) AS date"
    )
    known = " AND ".join(f"{c} IS NOT NULL" for c in by)
    return spread.selectExpr(
        "date", *by, *[f"coalesce(if(date <=> day AND {known}, {c}, NULL), {v}) AS {c}" for c, v in fill.items()]
    )
