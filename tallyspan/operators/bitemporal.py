"""States by two clocks: the day that they hold for, and the run by which they were known.

A version of a row holds from the run that wrote it to the one that wrote the next version of its
key.  So what was known at a run is a table like any other, and the state of a day at a run is
the state of that day in that table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.operators.history import state_history
from tallyspan.operators.panel import asof_lookup

BETWEEN = ":"


def _at_run(licence: str) -> Column:
    return F.concat(F.col("run_id").cast("string"), F.lit(BETWEEN), F.col(licence).cast("string"))


def known_intervals(versions: DataFrame, key: str, written: str = "written") -> DataFrame:
    """Adds ``known_until``, the run of the next version of the key, NULL for the last one."""
    following = F.lead(written).over(Window.partitionBy(key).orderBy(written))
    return versions.withColumn("known_until", following)


def known_at_runs(versions: DataFrame, key: str, runs: Sequence[int], written: str = "written") -> DataFrame:
    """Adds ``run_id``: a row for each of the ``runs`` at which a version was the known one.
    A version comes as often as there are such runs, and no pair of others is formed."""
    asked = F.array(*[F.lit(r).cast("long") for r in sorted(set(runs))])
    until = F.col("known_until")
    holds = F.filter(asked, lambda run: (run >= F.col(written)) & (until.isNull() | (run < until)))
    intervals = known_intervals(versions, key, written)
    return intervals.withColumn("run_id", F.explode(holds)).drop("known_until")


def history_at_runs(initial: DataFrame, changes: DataFrame, runs: Sequence[int]) -> DataFrame:
    """State history per run, with ``license_id`` as text "run:licence"; the tables hold all
    versions of their rows, with ``written``."""

    def named(rows: DataFrame, key: str) -> DataFrame:
        return known_at_runs(rows, "id", runs).withColumn(key, _at_run(key))

    return state_history(named(initial, "id"), named(changes, "license_id"))


def asof_known_at(points: DataFrame, initial: DataFrame, changes: DataFrame, point_id: str) -> DataFrame:
    """Adds to each point (license_id, date, run_id, ...) the state of that day as it was known
    after that run.

    The runs that points ask for are collected first: a number for each run at most.
    """
    runs = [r[0] for r in points.select("run_id").where("run_id IS NOT NULL").distinct().collect()]
    states = history_at_runs(initial, changes, runs)
    asked = points.withColumnRenamed("license_id", "_license").withColumn("license_id", _at_run("_license"))
    found = asof_lookup(asked, states, point_id)
    answer = [c for c in found.columns if c not in asked.columns]
    return found.select(*[F.col("_license").alias(c) if c == "license_id" else F.col(c) for c in points.columns], *answer)
