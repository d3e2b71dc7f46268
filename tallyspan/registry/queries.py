"""Registered queries: (spark, sf_dir) -> DataFrame over the whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.columns import utc_timestamp
from tallyspan.operators import (
    allocation,
    bitemporal,
    dedup,
    history,
    metrics,
    panel,
    profiling,
    quality,
    ranking,
    spine,
)
from tallyspan.operators import upsert as upserts
from tallyspan.plans import incremental
from tallyspan.plans import metrics as plans
from tallyspan.plans.metric_store import MetricStore
from tallyspan.session import scratch_path, store_and_reload
from tallyspan.sources import files
from tallyspan.sources import fixtures as fx
from tallyspan.streaming import changes as changes_stream
from tallyspan.streaming import live

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


@query
def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.ordered(plans.license_metrics(*fx.dense(spark, sf_dir)))


@query
def mart_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.ordered(plans.license_metrics(*fx.sparse(spark, sf_dir)))


@query
def mart_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.ordered(plans.license_metrics(*fx.sparse(spark, sf_dir, "edge")))


@query
def mart_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.license_metrics(*fx.with_gaps(spark, sf_dir))


@query
def mart_gaps_colfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.license_metrics(*fx.with_gaps(spark, sf_dir), fill="column")


# --- state history and its parts ------------------------------------------------


@query
def stg_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.stage_initial(fx.dense(spark, sf_dir, "edge")[0])


@query
def stg_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.stage_changes(fx.dense_changes(spark, sf_dir))


@query
def initial_not_superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.initial_not_superseded(*fx.dense(spark, sf_dir, "edge"))


@query
def state_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.state_history(*fx.dense(spark, sf_dir, "edge"))


@query
def state_history_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.state_history(*fx.sparse(spark, sf_dir))


@query
def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, changes = fx.with_faults(spark, sf_dir)
    return dedup.latest_per_key(changes, ["id"], [F.col("ord").desc()])


@query
def first_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, changes = fx.with_faults(spark, sf_dir)
    return dedup.flag_first_occurrence(changes, "id", "ord").select("id", "ord", "is_first")


# --- calendar and grids ---------------------------------------------------------


@query
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spine.calendar(spine.calendar_bounds(*fx.sparse(spark, sf_dir, "edge")))


@query
def license_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.license_types(*fx.dense(spark, sf_dir))


@query
def date_type_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.date_type_grid(*fx.sparse(spark, sf_dir))


@query
def densify(spark: SparkSession, sf_dir: str) -> DataFrame:
    initial, changes = fx.sparse(spark, sf_dir)
    counts = changes.groupBy("date", "type").agg(F.count("*").alias("n_changes"))
    return spine.densify(counts, ["type"], spine.calendar_bounds(initial, changes), {"n_changes": 0})


# --- panel ----------------------------------------------------------------------


@query
def daily_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.daily_states(*fx.dense(spark, sf_dir, "edge"))


@query
def daily_states_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.daily_states(*fx.with_gaps(spark, sf_dir))


@query
def daily_states_colfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.daily_states(*fx.with_gaps(spark, sf_dir), fill="column")


@query
def asof_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    initial, changes = fx.sparse(spark, sf_dir, "edge")
    points = changes.select(F.col("id").alias("point_id"), "license_id", F.date_add("date", 45).alias("date"))
    return panel.asof_lookup(points, history.state_history(initial, changes), "point_id")


@query
def license_daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.license_daily_series(history.state_history(*fx.dense(spark, sf_dir)))


# --- metrics --------------------------------------------------------------------


@query
def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.daily_metrics(*fx.dense(spark, sf_dir, "edge"))


@query
def daily_metrics_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.daily_metrics(*fx.with_gaps(spark, sf_dir))


@query
def daily_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.daily_price(*fx.dense(spark, sf_dir))


@query
def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.daily_events(*fx.dense(spark, sf_dir))


@query
def panel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a panel in which a licence-day may have several rows: the change log."""
    initial, changes = fx.dense(spark, sf_dir)
    bounds = spine.calendar_bounds(initial, changes)
    return metrics.panel_counts(changes, bounds, [F.col("id").desc()])


@query
def panel_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    initial, changes = fx.dense(spark, sf_dir)
    return metrics.panel_price(changes, spine.calendar_bounds(initial, changes))


@query
def mart_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.preview(mart(spark, sf_dir), 10)


@query
def gate_min_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.has_min_rows(plans.license_metrics(*fx.dense(spark, sf_dir)), 9)


@query
def view_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    plans.register_views(spark, *fx.dense(spark, sf_dir, "edge"))
    return spark.sql("SELECT * FROM mart_license_metrics ORDER BY date, type")


@query
def src_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables to CSV and back, the metrics to CSV and back."""
    root = scratch_path(spark, "csv")
    for name, df in zip(("initial", "changes"), fx.dense(spark, sf_dir)):
        files.write_csv(df, f"{root}/{name}")
    result = plans.license_metrics(*files.read_licenses(spark, f"{root}/initial", f"{root}/changes"))
    files.write_csv(result, f"{root}/mart")
    return files.read_csv(spark, f"{root}/mart", result.schema)


@query
def src_csv_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log as CSV, read with UTC timestamps and cut to a window."""
    path = scratch_path(spark, "csv")
    changes = fx.sparse_changes(spark, sf_dir)
    files.write_csv(changes, path)
    timed = files.read_csv_utc(spark, path, changes.schema, "date")
    start, end = dt.datetime(1996, 1, 1, 10, 0), dt.datetime(1997, 12, 31, 10, 0)
    return upserts.select_window(timed, "date", start, end).withColumn("date", F.to_date("date"))


@query
def parse_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text to UTC time; text with an offset is rejected."""
    text = F.concat(F.col("ts").cast("string"), F.when(F.col("event_type") == "error", "+02:00").otherwise(""))
    events = fx.table(spark, sf_dir, "events").withColumn("text", text)
    return events.select("event_id", F.unix_micros(utc_timestamp(F.col("text"))).alias("micros"))


@query
def src_csv_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with its columns in another order and one more is read by its header."""
    path = scratch_path(spark, "csv")
    changes = fx.sparse_changes(spark, sf_dir)
    swapped = changes.select("type", "license_id", F.lit("x").alias("note"), "id", "renewable", "price", "date")
    files.write_csv(swapped, path)
    return files.read_csv(spark, path, changes.schema)


@query
def src_table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table written twice, with times that become dates; the second one stays."""
    path = scratch_path(spark, "table")
    name = f"changes_{path.rsplit('-', 1)[-1]}"
    changes = fx.sparse_changes(spark, sf_dir).withColumn("date", F.col("date").cast("timestamp"))
    files.replace_table(changes.where("id % 2 = 0").withColumn("price", F.col("price") + 1), name, "date", path)
    files.replace_table(changes, name, "date", path)
    return spark.table(name)


# --- quality --------------------------------------------------------------------


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(*fx.with_faults(spark, sf_dir))


@query
def dq_flagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.flag_changes(*fx.with_faults(spark, sf_dir))


@query
def dq_flagged_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.flag_entities(*fx.with_faults(spark, sf_dir), position="ord")


@query
def dq_creation_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.early_changes(*fx.with_faults(spark, sf_dir))


@query
def dq_duplicate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    initial, _ = fx.with_faults(spark, sf_dir)
    return dedup.flag_first_occurrence(initial, "id", "ord").where("NOT is_first").select("id", "ord")


@query
def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphan_changes(*fx.with_faults(spark, sf_dir))


@query
def dq_unchanged_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as licences, events as their changes: most customers have no event."""
    initial = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return quality.unchanged_entities(initial, fx.dense_changes(spark, sf_dir))


@query
def dq_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failing_rows(*fx.with_faults(spark, sf_dir), kind="type")


@query
def dq_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failing_rows(*fx.with_faults(spark, sf_dir), kind="price")


@query
def dq_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distribution_checks(fx.sparse(spark, sf_dir)[0])


@query
def dq_distribution_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences with a change in the 90 days up to the first of every month, from stored
    sketches of each day, and whether they are within 6 % of the exact count."""
    changes = fx.sparse_changes(spark, sf_dir)
    sketches = store_and_reload(quality.daily_sketches(changes, "date", ["license_id"]), "sketches")
    months = changes.select(F.add_months(F.trunc("date", "month"), 1).alias("last_day")).distinct()
    windows = months.withColumn("first_day", F.date_sub("last_day", 89))
    estimated = quality.distinct_in_windows(sketches, windows, "date", ["license_id"])
    days = windows.withColumn("date", F.explode(F.sequence("first_day", "last_day")))
    exact = days.join(changes, "date").groupBy("last_day").agg(F.countDistinct("license_id").alias("n_licenses"))
    close = F.abs(F.col("license_id") - F.col("n_licenses")) <= 0.06 * F.col("n_licenses")
    return exact.join(estimated, "last_day").select("first_day", "last_day", "n_licenses", close.alias("is_close"))


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    initial, changes = fx.with_gaps(spark, sf_dir)
    counts = ["active_license_count", "inactive_license_count", "active_license_price"]
    return quality.not_null_report(
        {
            "stg_initial": (history.stage_initial(initial), ["license_id", "creation_date", "type"]),
            "state_history": (history.state_history(initial, changes), ["renewable", "type"]),
            "mart": (plans.license_metrics(initial, changes), counts),
        }
    )


@query
def dq_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    initial, changes = fx.with_gaps(spark, sf_dir)
    bounds = spine.calendar_bounds(initial, changes)
    return quality.panel_quality(history.state_intervals(initial, changes, "column"), bounds)


@query
def dq_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.consistency_report(*fx.with_faults(spark, sf_dir), as_of=dt.date(2024, 1, 25))


@query
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    initial, changes = fx.with_faults(spark, sf_dir)
    panel = history.state_history(*fx.with_gaps(spark, sf_dir))
    return quality.accepted_values_report(
        {
            "license_changes": (changes, {"type": ["PASS", "SIM", "SUPERVISION"], "price": [100, 1000, 5000]}),
            "initial_licenses": (initial, {"type": ["PASS", "SIM", "SUPERVISION"]}),
            "state_history": (panel, {"renewable": [True, False]}),
        }
    )


@query
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    initial, changes = fx.with_faults(spark, sf_dir)
    orders, customers = fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "customer")
    return quality.relationships_report(
        [
            ("license_changes", changes, "license_id", "initial_licenses", initial, "id"),
            ("initial_licenses", initial, "id", "license_changes", changes, "license_id"),
            ("orders", orders, "o_custkey", "customer", customers, "c_custkey"),
        ]
    )


@query
def dq_mart_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    initial, changes = fx.sparse(spark, sf_dir, "edge")
    return quality.mart_invariants(plans.license_metrics(initial, changes), initial, changes)


@query
def dq_transition_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = history.state_history(*fx.sparse(spark, sf_dir))
    return profiling.transition_row_sums(profiling.type_transitions(states))


@query
def price_by_type_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.price_by_type_check(plans.license_metrics(*fx.dense(spark, sf_dir)))


@query
def mart_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    initial, changes = fx.sparse(spark, sf_dir, "edge")
    bounds = spine.calendar_bounds(initial, changes)
    return quality.mart_conservation(plans.license_metrics(initial, changes), initial, bounds)


# --- profiles -------------------------------------------------------------------


@query
def prof_seasonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.creation_seasonality(fx.sparse(spark, sf_dir)[0])


@query
def prof_customer_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.customer_concentration(fx.sparse(spark, sf_dir)[0])


@query
def prof_changes_per_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.changes_per_license(fx.sparse_changes(spark, sf_dir))


@query
def prof_change_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.change_count_histogram(fx.sparse_changes(spark, sf_dir))


@query
def prof_price_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.price_moves(history.state_history(*fx.sparse(spark, sf_dir)))


@query
def prof_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.type_transitions(history.state_history(*fx.sparse(spark, sf_dir)))


@query
def prof_steady_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = profiling.type_transitions(history.state_history(*fx.sparse(spark, sf_dir)))
    return profiling.steady_state(counts).withColumn("share", F.round("share", 6))


# --- allocation and log states --------------------------------------------------


@query
def apportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders split over the customers (keys from 1) by a Pareto weight."""
    keys = fx.table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).alias("customer_key"))
    total = fx.table(spark, sf_dir, "orders").agg(F.count("*")).scalar()
    return allocation.apportion(keys, "customer_key", total)


@query
def repeat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = profiling.changes_per_license(fx.sparse_changes(spark, sf_dir))
    return allocation.repeat_rows(counts, "n_changes").select("license_id", "copy")


@query
def assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = fx.sparse_changes(spark, sf_dir).select("id", "date")
    return ranking.assign_batches(changes, 1000, "date", "id")


@query
def toggle_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = f"if(event_type = 'error', 'RENEW_TYPE', {fx.type_by_remainder('event_id')}) AS label"
    log = fx.table(spark, sf_dir, "events").selectExpr("user_id", "event_id", label)
    return ranking.toggle_states(log, "user_id", "event_id", "label", width=1000)


# --- incremental runs -----------------------------------------------------------


def _store(spark: SparkSession) -> incremental.Store:
    return incremental.Store(scratch_path(spark, "store"))


def _half_and_last(changes: DataFrame) -> tuple[int, dt.date]:
    """The id in the middle of the arrival order, and the last event date."""
    top_id, last = changes.agg(F.max("id"), F.max("date")).first()
    return top_id // 2, last


@query
def inc_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = dt.datetime(1996, 1, 1, 10, 0), dt.datetime(1997, 12, 31, 10, 0)
    return upserts.select_window(fx.sparse_changes(spark, sf_dir), "date", start, end)


@query
def inc_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    incremental.run_incremental(spark, *fx.sparse(spark, sf_dir), store, "1996-12-31T10:10:00")
    return store.rows(spark, "changes")


def _overlapping(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Target until 1997 and incoming from 1997 on, which meet in the year 1997."""
    target = changes.where(F.col("date") < dt.date(1998, 1, 1))
    incoming = changes.where(F.col("date") >= dt.date(1997, 1, 1)).withColumn("price", F.col("price") + 1)
    return target, incoming


@query
def inc_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, incoming = _overlapping(fx.sparse_changes(spark, sf_dir))
    return upserts.upsert(target, incoming, "id", [F.col("date").desc()])


@query
def inc_upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, incoming = _overlapping(fx.sparse_changes(spark, sf_dir))
    newest = [F.col("date").desc()]
    once = upserts.upsert(target, incoming, "id", newest)
    return upserts.upsert(once, incoming, "id", newest)


@query
def inc_batches_equal_one_shot(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    initial, changes = fx.sparse(spark, sf_dir)
    for as_of in ("1995-06-30T00:00:00", "1997-06-30T00:00:00", "2001-12-31T00:00:00"):
        incremental.run_incremental(spark, initial, changes, store, as_of)
    return store.rows(spark, "changes")


@query
def inc_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    initial, changes = fx.sparse(spark, sf_dir)
    for as_of in ("1995-06-30T00:00:00", "1997-06-30T00:00:00"):
        incremental.run_incremental(spark, initial, changes, store, as_of)
    return store.checkpoints(spark).select(
        "run_id",
        F.to_date("last_data_timestamp").alias("last_data_date"),
        F.to_date("last_processed_timestamp").alias("last_processed_date"),
    )


@query
def inc_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly batches of which one failed."""
    month = F.date_format("date", "yyyy-MM")
    batches = (
        fx.sparse_changes(spark, sf_dir)
        .groupBy(month.alias("month"))
        .agg(F.min("date").alias("min_event"), F.max("date").alias("max_event"))
        .withColumn("succeeded", F.col("month") != "1996-03")
    )
    epoch = F.lit(dt.date(1970, 1, 1))
    return upserts.advance_watermarks(batches, epoch, epoch)


@query
def inc_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the log arrives after the first run; a backfill of a year
    picks up only the rows whose date lies in that year."""
    store = _store(spark)
    initial, changes = fx.sparse(spark, sf_dir)
    half, last = _half_and_last(changes)
    as_of = dt.datetime(last.year, last.month, last.day)
    incremental.run_incremental(spark, initial, changes.where(F.col("id") < half), store, as_of)
    incremental.run_backfill(spark, initial, changes, store, as_of, days=365)
    return store.rows(spark, "changes")


@query
def late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = fx.sparse_changes(spark, sf_dir)
    half, _ = _half_and_last(changes)
    known, incoming = changes.where(F.col("id") < half), changes.where(F.col("id") >= half)
    watermark = known.agg(F.date_sub(F.max("date"), 365)).scalar()
    on_time, late = upserts.split_late(incoming, "date", watermark)
    return on_time.withColumn("is_late", F.lit(False)).unionByName(late.withColumn("is_late", F.lit(True)))


@query
def recompute_affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored deltas of the first half of the log plus the second half as late rows."""
    initial, changes = fx.sparse(spark, sf_dir, "edge")
    half, _ = _half_and_last(changes)
    known, late = changes.where(F.col("id") < half), changes.where(F.col("id") >= half)
    intervals = history.state_intervals(initial, known, keep_hidden=True)
    stored = store_and_reload(metrics.interval_deltas(intervals), "deltas")
    return upserts.recompute_affected(stored, initial, known, late)


@query
def metric_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored deltas: built from the first half of the log, corrected by the second."""
    initial, changes = fx.sparse(spark, sf_dir, "edge")
    half, _ = _half_and_last(changes)
    known, late = changes.where(F.col("id") < half), changes.where(F.col("id") >= half)
    stored = MetricStore(scratch_path(spark, "metrics"))
    stored.build(spark, initial, known)
    stored.correct(1, initial, known, late)
    return stored.mart(spark)


def _commit(spark: SparkSession, store: incremental.Store, changes: DataFrame) -> None:
    state = store.state(spark)
    written = incremental.write_batch(spark, store, "changes", changes, state)
    incremental.commit(spark, store, state, written, incremental.next_checkpoint(spark, state.last, []))


@query
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that move by 45 days leave their old day and enter the new one."""
    store = _store(spark)
    changes = fx.sparse_changes(spark, sf_dir)
    _commit(spark, store, changes)
    _commit(spark, store, changes.where(~F.col("renewable")).withColumn("date", F.date_add("date", 45)))
    return store.read(spark, "changes").select("id", "date", "event_day")


@query
def inc_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth id is missing and some rows come twice; the same window three times."""
    store = _store(spark)
    initial, changes = fx.sparse(spark, sf_dir)
    changes = changes.withColumn("id", F.when(F.col("id") % 10 != 0, F.col("id")))
    changes = changes.unionByName(changes.where("id IS NULL AND price = 100"))
    for _ in range(3):
        incremental.run_incremental(spark, initial, changes, store, "2001-12-31", start="1970-01-01")
    lost = store.rows(spark, "rejected_changes").drop("content").withColumn("rejected", F.lit(True))
    return store.rows(spark, "changes").withColumn("rejected", F.lit(False)).unionByName(lost)


@query
def inc_run_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermarks after runs of which the second fails on a row it cannot convert."""
    store = _store(spark)
    initial, changes = fx.sparse(spark, sf_dir)
    broken = changes.withColumn("price", F.when(F.col("price") > 0, F.raise_error(F.lit("no price")).cast("long")))
    incremental.run_incremental(spark, initial, changes, store, "1995-06-30")
    try:
        incremental.run_incremental(spark, initial, broken, store, "1997-06-30")
    except Exception as error:
        if "no price" not in str(error):
            raise
    return store.checkpoints(spark).select(
        "run_id",
        F.to_date("last_data_timestamp").alias("last_data_date"),
        F.to_date("last_processed_timestamp").alias("last_processed_date"),
    )


def _updated(changes: DataFrame) -> DataFrame:
    """New versions of every tenth row: another licence, a later day, other attributes."""
    return changes.where("id % 10 = 3").withColumns(
        {
            "license_id": F.when(F.col("id") % 20 == 3, F.col("license_id") + 1).otherwise(F.col("license_id")),
            "date": F.date_add("date", 30),
            "type": F.lit("SUPERVISION"),
            "price": F.lit(5000).cast("long"),
            "renewable": ~F.col("renewable"),
        }
    )


@query
def recompute_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run stores rows and metrics; a second one brings new versions of known ids."""
    store = _store(spark)
    initial, changes = fx.sparse(spark, sf_dir, "edge")
    incremental.run_incremental(spark, initial, changes, store, "2001-12-31", with_metrics=True)
    none = initial.limit(0)
    incremental.run_incremental(
        spark, none, _updated(changes), store, "2001-12-31", start="1970-01-01", with_metrics=True
    )
    return store.mart(spark)


@query
def inc_metrics_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs, the second without metrics and with new versions of known rows: the third
    one takes up both."""
    store = _store(spark)
    initial, changes = fx.sparse(spark, sf_dir, "edge")
    half, last = _half_and_last(changes)
    end = dt.datetime(last.year, last.month, last.day) + dt.timedelta(days=60)
    incremental.run_incremental(spark, initial, changes.where(F.col("id") < half), store, end, start="1970-01-01", with_metrics=True)
    none = initial.limit(0)
    incremental.run_incremental(spark, none, _updated(changes), store, end, start="1970-01-01", with_metrics=False)
    rest = changes.where((F.col("id") >= half) & (F.col("id") % 10 != 3))
    incremental.run_incremental(spark, none, rest, store, end, start="1970-01-01")
    return store.mart(spark)


@query
def dq_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation report after three runs with faults, new versions and entities that
    come late, from counts kept with each run."""
    store = incremental.Store(scratch_path(spark, "store"), keep_quality=True)
    initial, changes = (df.where("ord = 0").drop("ord") for df in fx.with_faults(spark, sf_dir))
    half, last = _half_and_last(changes)
    end = dt.datetime(last.year, last.month, last.day) + dt.timedelta(days=60)
    rest = changes.where((F.col("id") >= half) & (F.col("id") % 10 != 3))
    for entities, rows, metrics_too in (
        (initial.where("id % 2 = 0"), changes.where(F.col("id") < half), True),
        (initial.where("id % 2 = 1"), _updated(changes), False),
        (initial.limit(0), rest, True),
    ):
        incremental.run_incremental(spark, entities, rows, store, end, start="1970-01-01", with_metrics=metrics_too)
    return store.quality_report(spark)


@query
def inc_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a date, some of them without a key as well; the same window twice."""
    store = _store(spark)
    initial, changes = fx.sparse(spark, sf_dir)
    changes = changes.withColumns(
        {
            "date": F.when(F.col("id") % 9 != 4, F.col("date")),
            "id": F.when(F.col("id") % 27 != 13, F.col("id")),
        }
    )
    for _ in range(2):
        incremental.run_incremental(spark, initial, changes, store, "2001-12-31", start="1970-01-01")
    lost = store.rows(spark, "rejected_changes").drop("content").withColumn("rejected", F.lit(True))
    return store.rows(spark, "changes").withColumn("rejected", F.lit(False)).unionByName(lost)


@query
def inc_rejected_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    initial, changes = fx.sparse(spark, sf_dir)
    changes = changes.withColumns(
        {
            "date": F.when(F.col("id") % 9 != 4, F.col("date")),
            "id": F.when(F.col("id") % 7 != 3, F.col("id")),
        }
    )
    incremental.run_incremental(spark, initial, changes, store, "2001-12-31", start="1970-01-01")
    return incremental.rejected_report(spark, store)


@query
def inc_late_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh change comes after a run that has passed its day."""
    store = _store(spark)
    initial, changes = fx.sparse(spark, sf_dir)
    incremental.run_incremental(spark, initial, changes.where("id % 11 <> 7"), store, "1996-06-30")
    late = incremental.late_rows(spark, initial, changes, store)
    return incremental.backfill_span(late, "1996-06-30")


@query
def inc_late_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, and a backfill of as many days as the late rows need."""
    store = _store(spark)
    initial, changes = fx.sparse(spark, sf_dir)
    incremental.run_incremental(spark, initial, changes.where("id % 11 <> 7"), store, "1996-06-30")
    incremental.run_backfill(spark, initial, changes, store, "1996-06-30", days=None)
    return store.rows(spark, "changes")


def _three_versions(spark: SparkSession, sf_dir: str) -> incremental.Store:
    """Run 1: half of the changes; run 2: new versions of some of all; run 3: the rest."""
    store = incremental.Store(scratch_path(spark, "store"), keep_versions=True)
    initial, changes = fx.sparse(spark, sf_dir, "edge")
    half, _ = _half_and_last(changes)
    none = initial.limit(0)
    for entities, rows in (
        (initial, changes.where(F.col("id") < half)),
        (none, _updated(changes)),
        (none, changes.where((F.col("id") >= half) & (F.col("id") % 10 != 3))),
    ):
        incremental.run_incremental(spark, entities, rows, store, "2001-12-31", start="1970-01-01")
    return store


@query
def rows_known_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change rows as they were after the second of three runs."""
    return _three_versions(spark, sf_dir).rows_at(spark, "changes", 2)


@query
def asof_known_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of a day as it was known after one of three runs."""
    store = _three_versions(spark, sf_dir)
    points = fx.sparse_changes(spark, sf_dir).selectExpr(
        "id AS point_id", "license_id", "date_add(date, 45) AS date", "1 + id % 3 AS run_id"
    )
    return bitemporal.asof_known_at(points, store.versions(spark, "initial"), store.versions(spark, "changes"), "point_id")


# --- streams --------------------------------------------------------------------


def _as_files(df: DataFrame, label: str, parts: list[str]) -> str:
    """The rows of each condition as the files of one arrival, one after the other: the
    input of a file stream.  The files of an arrival have a time of their own."""
    path = scratch_path(df.sparkSession, label)
    for number, part in enumerate(parts):
        df.where(part).write.mode("append").parquet(path)
        files.set_times(df.sparkSession, path, 1_700_000_000 + 1000 * number)
    return path


def _halves(df: DataFrame, column: str) -> list[str]:
    low, high = df.agg(F.min(column), F.max(column)).first()
    middle = low + (high - low) / 2
    text = f"TIMESTAMP '{middle}'" if isinstance(middle, dt.datetime) else f"{int(middle)}"
    return [f"{column} <= {text}", f"{column} > {text}"]


def _span_days(df: DataFrame, column: str) -> str:
    """A delay that no row exceeds: the span of the event times."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return f"{(high - low).days + 2} days"


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice, kept once."""
    events = fx.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    source = _as_files(events.unionByName(events), "events", _halves(events, "ts"))
    stream = changes_stream.read_stream(spark, source, events.schema)
    output, state = scratch_path(spark, "dedup"), scratch_path(spark, "state")
    once = changes_stream.dedup_stream(stream, "event_id", "ts", _span_days(events, "ts"))
    changes_stream.run_to_parquet(once.drop("ts"), output, state)
    return spark.read.parquet(output)


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an id divisible by 5 arrive last, after the others have come twice; those a
    day or more older than the latest event are dropped.  (A batch's late rows are those
    behind the watermark of the batch before it.)"""
    events = fx.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    events = events.coalesce(1)
    source = _as_files(events, "events", ["event_id % 5 <> 0", "event_id % 5 <> 0", "event_id % 5 = 0"])
    stream = changes_stream.read_stream(spark, source, events.schema, files_per_batch=1)
    output, state = scratch_path(spark, "dedup"), scratch_path(spark, "state")
    once = changes_stream.dedup_stream(stream, "event_id", "ts", "1 day")
    changes_stream.run_to_parquet(once.drop("ts"), output, state)
    return spark.read.parquet(output)


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = fx.dense_changes(spark, sf_dir)
    source = _as_files(changes, "changes", _halves(changes, "id"))
    store = _store(spark)
    stream = changes_stream.read_stream(spark, source, changes.schema)
    changes_stream.run_upserts(stream, store, scratch_path(spark, "state"))
    return store.rows(spark, "changes")


@query
def stream_after_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run brings the odd ids, then a stream the even ones: batch 0 is not the run's."""
    initial, changes = fx.dense(spark, sf_dir)
    store = _store(spark)
    incremental.run_incremental(spark, initial, changes.where("id % 2 = 1"), store, "2100-01-01")
    _upsert_stream(spark, store, changes.where("id % 2 = 0"), scratch_path(spark, "state"))
    return store.rows(spark, "changes")


@query
def stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams into one store, and the first one's batches delivered again."""
    changes = fx.dense_changes(spark, sf_dir)
    store, state = _store(spark), scratch_path(spark, "state")
    first = _upsert_stream(spark, store, changes.where("id % 2 = 1"), state)
    _upsert_stream(spark, store, changes.where("id % 2 = 0"), scratch_path(spark, "state"))
    name = changes_stream.stream_id(spark, state)
    again = changes_stream.read_stream(spark, first, changes.schema)
    changes_stream.run_upserts(again, store, scratch_path(spark, "state"), source_id=name)
    return store.rows(spark, "changes")


def _upsert_stream(spark: SparkSession, store: incremental.Store, rows: DataFrame, state: str) -> str:
    source = _as_files(rows, "changes", ["true"])
    changes_stream.run_upserts(changes_stream.read_stream(spark, source, rows.schema), store, state)
    return source


@query
def stream_then_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run begins the metrics, a stream without them brings rows, and they are caught up."""
    initial, changes = fx.sparse(spark, sf_dir, "edge")
    store = _store(spark)
    incremental.run_incremental(spark, initial, changes.where("id % 2 = 1"), store, "2100-01-01", with_metrics=True)
    source = _as_files(changes.where("id % 2 = 0"), "changes", ["true"])
    stream = changes_stream.read_stream(spark, source, changes.schema)
    changes_stream.run_upserts(stream, store, scratch_path(spark, "state"), with_metrics=False)
    incremental.refresh_metrics(spark, store)
    return store.mart(spark)


@query
def stream_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities and changes as streams that end in the daily metrics: half of the changes in
    two batches, a restart with the other half, and the first half delivered again."""
    initial, changes = fx.sparse(spark, sf_dir, "edge")
    stored = MetricStore(scratch_path(spark, "metrics"))
    state = scratch_path(spark, "state")
    sources = {
        "entities": _as_files(initial, "entities", ["id % 2 = 0", "id % 2 = 1"]),
        "changes": _as_files(changes, "changes", ["id % 4 = 0", "id % 4 = 1"]),
    }
    for more in ([], ["id % 4 >= 2"], ["id % 4 <= 1"]):
        for part in more:
            changes.where(part).write.mode("append").parquet(sources["changes"])
        streams = {
            n: changes_stream.read_stream(spark, p, df.schema, files_per_batch=16)
            for (n, p), df in zip(sources.items(), (initial, changes))
        }
        live.run_live_mart(streams["entities"], streams["changes"], stored, state)
    return stored.mart(spark)


@query
def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").select("ts", "event_type")
    source = _as_files(events, "events", _halves(events, "ts"))
    stream = changes_stream.read_stream(spark, source, events.schema)
    counts = changes_stream.daily_counts_stream(stream, "ts", "event_type", _span_days(events, "ts"))
    output = scratch_path(spark, "counts")
    changes_stream.run_updates(counts, output, scratch_path(spark, "state"))
    return changes_stream.latest_updates(spark.read.parquet(output), ["date", "type"])
