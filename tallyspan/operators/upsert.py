"""Upserts, event-time windows, late rows and corrections, as plans."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.operators import metrics
from tallyspan.operators.dedup import latest_per_key
from tallyspan.operators.history import state_intervals
from tallyspan.operators.skew import BROADCAST_KEYS, rows_of_keys
from tallyspan.session import store_and_reload


def upsert(target: DataFrame, incoming: DataFrame, key: str, newest_first: Sequence[Column]) -> DataFrame:
    """Incoming rows replace target rows of the same key; the newest incoming row of
    a key counts.  Applying the same rows again changes nothing."""
    fresh = latest_per_key(incoming, [key], newest_first)
    return target.join(fresh.select(key), key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def as_utc(value: datetime | str) -> datetime:
    """UTC time; text must not name an offset, and a time without a zone is UTC."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
        if value.tzinfo is not None:
            raise ValueError("give timestamps in UTC without an offset")
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def select_window(df: DataFrame, event_column: str, start: datetime, end: datetime) -> DataFrame:
    """Rows with start <= event time <= end, both bounds in UTC.

    A date counts as its midnight, so for a date column the bounds become dates: the
    comparison stays on the stored type and reaches the parquet scan.
    """
    start, end = as_utc(start), as_utc(end)
    if isinstance(df.schema[event_column].dataType, T.DateType):
        midnight = datetime.combine(start.date(), time.min, start.tzinfo)
        first = start.date() + timedelta(days=int(start > midnight))
        return df.where(F.col(event_column).between(F.lit(first), F.lit(end.date())))
    return df.where(F.col(event_column).between(F.lit(start), F.lit(end)))


def split_late(incoming: DataFrame, event_column: str, watermark: Column) -> tuple[DataFrame, DataFrame]:
    """(on time, late): a row is late if its event time is before the watermark."""
    late = F.coalesce(F.col(event_column) < watermark, F.lit(False))
    return incoming.where(~late), incoming.where(late)


def advance_watermarks(batches: DataFrame, last_data: Column, last_processed: Column) -> DataFrame:
    """One row with both watermarks after a run.

    ``batches``: (min_event, max_event, succeeded).  The data watermark is the latest
    event seen.  The processed watermark is the latest event of a batch that
    succeeded, but it stops at the earliest event of a batch that failed, so that the
    next run reads that batch again.  Neither goes back.
    """
    failed = F.min(F.when(~F.col("succeeded"), F.col("min_event")))
    succeeded = F.max(F.when(F.col("succeeded"), F.col("max_event")))
    reached = F.when(failed.isNull(), succeeded).otherwise(F.least(failed, succeeded))
    return batches.agg(
        F.greatest(last_data, F.max("max_event")).alias("last_data_timestamp"),
        F.greatest(last_processed, reached).alias("last_processed_timestamp"),
        F.count_if(~F.col("succeeded")).alias("failed_batches"),
    )


def correction_deltas(
    initial: DataFrame,
    known: DataFrame,
    late: DataFrame,
    late_initial: DataFrame | None = None,
    replace_entities: bool = False,
) -> DataFrame:
    """What late rows add to the stored daily deltas: new minus old deltas of the
    licences they touch.

    ``late`` holds changes; a row with a known id is a new version and replaces the old
    one, also where it moves to another licence or day.  ``late_initial`` holds entity
    rows, which are added or, with ``replace_entities``, replace those of their id.

    The rows of the touched licences are picked out once and go through the history once:
    each belongs to the old history, the new one or both, and the two are told apart by the
    licence's key.  Old intervals count with the opposite sign.
    """
    # Few late rows are broadcast, and so are the licences they touch, at most two per row;
    # the tables are then only filtered where they are read.
    few = _few(late, late_initial)
    small = F.broadcast if few else lambda df: df
    late_ids = late.select("id").distinct()
    moved = known.select("id", "license_id").join(small(late_ids), "id", "left_semi")
    ids = late.select("license_id").union(moved.select("license_id"))
    if late_initial is not None:
        ids = ids.union(late_initial.select("id"))
    touched = ids.where("license_id IS NOT NULL").distinct()
    if few:
        before = known.join(F.broadcast(touched), "license_id", "left_semi")
        entities = initial.join(F.broadcast(touched.withColumnRenamed("license_id", "id")), "id", "left_semi")
    else:
        touched = store_and_reload(touched, "touched")
        before = rows_of_keys(known, touched, "license_id", "id")
        entities = rows_of_keys(initial, touched.withColumnRenamed("license_id", "id"), "id", "creation_date")
    return deltas_of_touched(entities, before, late, late_initial, replace_entities, few)


def _few(late: DataFrame, late_initial: DataFrame | None) -> bool:
    rows = [late.select("id"), *([] if late_initial is None else [late_initial.select("id")])]
    return all(r.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS for r in rows)


def deltas_of_touched(
    entities: DataFrame,
    before: DataFrame,
    late: DataFrame,
    late_initial: DataFrame | None = None,
    replace_entities: bool = False,
    few: bool | None = None,
    unplaced: DataFrame | None = None,
) -> DataFrame:
    """The same, given the entity rows and known changes of just the touched licences.  With
    ``unplaced``, the known changes without a licence that late ones replace, rows without a
    licence are counted one by one, as the deltas must have been from the start."""
    small = F.broadcast if (_few(late, late_initial) if few is None else few) else lambda df: df
    replaced = small(late.select("id").distinct().withColumn("_replaced", F.lit(True)))
    old = before.join(replaced, "id", "left").withColumn("_versions", _versions(F.col("_replaced").isNull()))
    changes = old.drop("_replaced").unionByName(late.withColumn("_versions", F.array(F.lit("new:"))))
    if late_initial is None:
        entities = entities.withColumn("_versions", _versions(F.lit(True)))
    else:
        if replace_entities:
            again = small(late_initial.select("id").distinct().withColumn("_replaced", F.lit(True)))
            entities = entities.join(again, "id", "left")
        else:
            entities = entities.withColumn("_replaced", F.lit(None).cast("boolean"))
        entities = entities.withColumn("_versions", _versions(F.col("_replaced").isNull())).drop("_replaced")
        entities = entities.unionByName(late_initial.withColumn("_versions", F.array(F.lit("new:"))))

    def told_apart(rows: DataFrame, key: str) -> DataFrame:
        named = rows.withColumn("_version", F.explode("_versions")).drop("_versions", "_replaced")
        return named.withColumn(key, F.concat("_version", F.col(key).cast("string"))).drop("_version")

    if unplaced is not None:
        changes = changes.where("license_id IS NOT NULL")
    intervals = state_intervals(told_apart(entities, "id"), told_apart(changes, "license_id"), keep_hidden=True)
    deltas = metrics.interval_deltas(intervals, sign="if(license_id LIKE 'old:%', -1L, 1L)")
    if unplaced is None:
        return deltas
    return metrics.add_deltas(deltas, metrics.unplaced_days(late), metrics.unplaced_days(unplaced, -1))


def _versions(stays: Column) -> Column:
    """The histories that a known row belongs to."""
    both = F.array(F.lit("old:"), F.lit("new:"))
    return F.when(stays, both).otherwise(F.array(F.lit("old:")))


def recompute_affected(
    stored_deltas: DataFrame,
    initial: DataFrame,
    known: DataFrame,
    late: DataFrame,
    late_initial: DataFrame | None = None,
) -> DataFrame:
    """Daily metrics after late rows, from the stored deltas (with hidden days) and the
    licences that the late rows touch."""
    corrected = metrics.add_deltas(stored_deltas, correction_deltas(initial, known, late, late_initial))
    deltas = store_and_reload(corrected, "deltas")
    return metrics.mart_from_deltas(deltas, metrics.delta_bounds(deltas))
