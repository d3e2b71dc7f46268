"""Incremental and backfill runs over a store of two targets.

A run reads the event-time window since the last processed watermark, writes the rows of
each target once, as a segment, adds what they change to the stored metrics, and publishes
all of it, with its watermarks, in one step: the next version of the store's pointer.  A
run that stops earlier leaves files that nothing refers to, and the next run starts from
the state before it.

The metrics know up to which run they cover the rows.  A store that has metrics keeps them with
every run and every batch of a stream.  Where one is told not to, the next one that keeps them, or
``refresh_metrics``, takes up all rows since; until then ``Store.mart`` is an error.

Rows without a key cannot replace one another, and rows without a date are in no window.  They
go to a table of rejected rows, each with its content and its number among equal ones as the
key, so nothing is lost and a replay adds nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.operators import quality
from tallyspan.operators.dedup import latest_per_key
from tallyspan.operators.upsert import advance_watermarks, as_utc, select_window
from tallyspan.plans.history_store import REBUILD_GROWTH, HistoryStore, buckets_for
from tallyspan.plans.metric_store import MetricStore
from tallyspan.schemas import CHANGES_SCHEMA, CHECKPOINT_SCHEMA, INITIAL_SCHEMA
from tallyspan.session import store_and_reload
from tallyspan.sources.files import delete_path
from tallyspan.sources.pointer import Pointer
from tallyspan.sources.targets import DAY, FAN, WRITTEN, Target, newest_to_merge

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
BACKFILL_DAYS = 5
HISTORY = 100  # runs whose watermarks are remembered
COMPACT_AFTER = FAN  # runs of deltas
REJECTED = "rejected_"
ROWS = ("initial", "changes")


class StaleMetrics(RuntimeError):
    """The stored metrics do not cover all rows."""


def _micros(value: datetime) -> int:
    return (value - EPOCH) // timedelta(microseconds=1)


def _time(micros: int) -> datetime:
    return EPOCH + timedelta(microseconds=micros)


@dataclass(frozen=True)
class Checkpoint:
    run_id: int
    last_data: datetime
    last_processed: datetime


@dataclass(frozen=True)
class State:
    """What the pointer says: bounded by tables, remembered runs, segments and streams."""

    version: int = 0
    runs: tuple[Checkpoint, ...] = ()
    segments: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    retired: tuple[str, ...] = ()
    streams: Mapping[str, int] = field(default_factory=dict)
    metrics: Mapping[str, str] = field(default_factory=dict)
    sizes: Mapping[str, tuple[int, int]] = field(default_factory=dict)  # bytes and last run of each segment
    covered: int = 0  # the last run whose rows are in the metrics
    history: Mapping[str, int] = field(default_factory=dict)  # buckets, and bytes when it was built
    quality: tuple[str, ...] = ()  # folders of counts for the validation report

    @property
    def last(self) -> Checkpoint:
        return self.runs[-1] if self.runs else Checkpoint(0, EPOCH, EPOCH)

    def uncovered(self, table: str) -> list[str]:
        """Segments with rows that the metrics do not cover."""
        return [s for s in self.segments.get(table, ()) if self.sizes[s][1] > self.covered]

    def added(self, written: Mapping[str, str], sizes: Mapping[str, int], run: int) -> State:
        """With these segments behind the others of their tables."""
        segments = {t: (*self.segments.get(t, ()), written[t]) for t in written}
        return replace(
            self,
            segments={**self.segments, **segments},
            sizes={**self.sizes, **{s: (sizes[t], run) for t, s in written.items()}},
        )


@dataclass(frozen=True)
class Store:
    """Folders of one ingestion: targets, rejected rows, metrics, pointer.

    With ``keep_versions`` the two targets keep what later runs replace, for ``rows_at``.  With
    ``keep_quality`` the counts of the validation report are kept with the metrics."""

    root: str
    keep_versions: bool = False
    keep_quality: bool = False

    @property
    def pointer(self) -> Pointer:
        return Pointer(f"{self.root}/state")

    @property
    def targets(self) -> dict[str, Target]:
        tables = {
            "initial": Target(f"{self.root}/initial", INITIAL_SCHEMA, "creation_date", keep_versions=self.keep_versions),
            "changes": Target(f"{self.root}/changes", CHANGES_SCHEMA, "date", keep_versions=self.keep_versions),
        }
        rejected = {}
        for name, t in tables.items():
            schema = T.StructType([*t.schema.fields, T.StructField("content", T.StringType())])
            rejected[REJECTED + name] = Target(f"{self.root}/{REJECTED}{name}", schema, t.date_column, "content")
        return tables | rejected

    @property
    def metrics(self) -> MetricStore:
        return MetricStore(f"{self.root}/metrics")

    def history(self, buckets: int) -> HistoryStore:
        return HistoryStore(f"{self.root}/history", buckets)

    def tables(self, state: State) -> dict[str, Target]:
        """The targets, and the tables behind the metrics if there are any."""
        return self.targets | (self.history(state.history["buckets"]).tables if state.history else {})

    def sizes(self, spark: SparkSession, state: State, written: Mapping[str, str]) -> dict[str, int]:
        tables = self.tables(state)
        return {t: tables[t].bytes_of(spark, s) for t, s in written.items()}

    def state(self, spark: SparkSession) -> State:
        version, content = self.pointer.read(spark)
        if not version:
            return State()
        return State(
            version,
            tuple(Checkpoint(r, _time(d), _time(p)) for r, d, p in content["runs"]),
            {k: tuple(v) for k, v in content["segments"].items()},
            tuple(content["retired"]),
            content["streams"],
            content["metrics"],
            {k: tuple(v) for k, v in content["sizes"].items()},
            content["covered"],
            content["history"],
            tuple(content["quality"]),
        )

    def publish(self, spark: SparkSession, state: State) -> None:
        content = {
            "runs": [[c.run_id, _micros(c.last_data), _micros(c.last_processed)] for c in state.runs[-HISTORY:]],
            "segments": {k: list(v) for k, v in state.segments.items()},
            "retired": list(state.retired),
            "streams": dict(state.streams),
            "metrics": dict(state.metrics),
            "sizes": {s: list(state.sizes[s]) for names in state.segments.values() for s in names},
            "covered": state.covered,
            "history": dict(state.history),
            "quality": list(state.quality),
        }
        self.pointer.publish(spark, state.version, content)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """Rows of a table with ``event_day``: one per key, the newest version."""
        return self.targets[table].read(spark, self.state(spark).segments.get(table, ()))

    def rows(self, spark: SparkSession, table: str) -> DataFrame:
        return self.read(spark, table).select(*self.targets[table].schema.fieldNames())

    def rows_at(self, spark: SparkSession, table: str, run: int) -> DataFrame:
        """The rows of a table as they were after a run; needs ``keep_versions``."""
        if not self.keep_versions:
            raise ValueError("this store does not keep versions")
        names = self.targets[table].schema.fieldNames()
        return self.targets[table].read(spark, self.state(spark).segments.get(table, ()), run).select(*names)

    def versions(self, spark: SparkSession, table: str) -> DataFrame:
        """Every version of every row, with the run that wrote it; needs ``keep_versions``."""
        if not self.keep_versions:
            raise ValueError("this store does not keep versions")
        target = self.targets[table]
        rows = target.versions(spark, self.state(spark).segments.get(table, ()))
        return rows.select(*target.schema.fieldNames(), WRITTEN)

    def mart(self, spark: SparkSession) -> DataFrame:
        """Daily metrics of the stored rows, from the stored deltas."""
        state = self.state(spark)
        self._fresh(state)
        return self.metrics.mart_of(spark, state.metrics)

    def quality_folder(self, name: str) -> str:
        return f"{self.root}/quality/{name}"

    def quality_report(self, spark: SparkSession) -> DataFrame:
        """The validation report of the stored rows, from one row of counts per run."""
        state = self.state(spark)
        self._fresh(state)
        if not self.keep_quality or not state.quality:
            raise ValueError("this store does not keep counts for the report")
        rows = spark.read.parquet(*[self.quality_folder(f) for f in state.quality])
        return quality.report_of_totals(rows.agg(*[F.sum(c).alias(c) for c in rows.columns]))

    def _fresh(self, state: State) -> None:
        late = [s for t in ROWS for s in state.uncovered(t)]
        if late:
            raise StaleMetrics(f"{len(late)} segments after run {state.covered} are not in the metrics; call refresh_metrics")

    def checkpoints(self, spark: SparkSession) -> DataFrame:
        """Watermarks of the last runs."""
        rows = [(c.run_id, c.last_data, c.last_processed) for c in self.state(spark).runs]
        return spark.createDataFrame(rows, CHECKPOINT_SCHEMA)


def load_checkpoint(spark: SparkSession, store: Store) -> Checkpoint:
    """Watermarks of the latest run; the epoch if there is none."""
    return store.state(spark).last


def split_rejected(rows: DataFrame, target: Target, undated: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows without one and ``undated`` ones under a key of their content)."""
    names = target.schema.fieldNames()
    rows = rows.select(*names)
    # Every value by itself, so that a missing one is not an empty one.
    text = F.to_json(F.struct(*[F.col(n).cast("string").alias(n) for n in names]), {"ignoreNullFields": "false"})
    lost = rows.where(F.col(target.key).isNull())
    if undated is not None:
        lost = lost.unionByName(undated.select(*names))
    lost = lost.withColumn("_content", F.sha2(text, 256))
    # Equal rows are counted before they are numbered, so none of them is shuffled twice.
    counted = lost.groupBy("_content").agg(F.count("*").alias("_n"), *[F.first(n).alias(n) for n in names])
    copies = counted.withColumn("_number", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    key = F.concat_ws("-", "_content", F.col("_number").cast("string"))
    return rows.where(F.col(target.key).isNotNull()), copies.select(*names, key.alias("content"))


def rejected_report(spark: SparkSession, store: Store) -> DataFrame:
    """(table_name, reason, n_rows) of the rejected rows, one row per table and reason."""
    parts = []
    for name in ROWS:
        target = store.targets[name]
        reason = F.when(F.col(target.key).isNull(), "no key").otherwise("no date")
        rows = store.rows(spark, REJECTED + name)
        parts.append(rows.groupBy(F.lit(name).alias("table_name"), reason.alias("reason")).agg(F.count("*").alias("n_rows")))
    return parts[0].unionByName(parts[1])


def write_batch(
    spark: SparkSession,
    store: Store,
    table: str,
    batch: DataFrame,
    state: State,
    newest_first: list | None = None,
    undated: DataFrame | None = None,
) -> dict[str, str]:
    """Segments of the rows of a batch: the newest per key, and those that are rejected."""
    target, sequence, run = store.targets[table], state.version + 1, state.last.run_id + 1
    keyed, lost = split_rejected(batch, target, undated)
    order = newest_first or [F.col(target.date_column).desc()]
    written = {table: target.write(spark, latest_per_key(keyed, [target.key], order), sequence, run)}
    if not lost.isEmpty():
        written[REJECTED + table] = store.targets[REJECTED + table].write(spark, lost, sequence, run)
    return written


def event_range(spark: SparkSession, target: Target, segment: str) -> tuple[datetime, datetime] | None:
    """Midnights of the first and the last event day of a segment."""
    day = F.col(target.date_column).cast("date")
    days = target.segment(spark, [segment]).agg(F.min(day), F.max(day)).first()
    return None if days[0] is None else tuple(as_utc(datetime(d.year, d.month, d.day)) for d in days)


def commit(
    spark: SparkSession,
    store: Store,
    state: State,
    written: Mapping[str, str],
    point: Checkpoint,
    streams: Mapping[str, int] | None = None,
    with_metrics: bool | None = None,
) -> State:
    """Publishes segments, watermarks and what the rows change in the metrics.  A store
    that has metrics keeps them unless ``with_metrics`` is False."""
    after = state.added(written, store.sizes(spark, state, written), point.run_id)
    after = replace(after, runs=(*state.runs, point), streams={**state.streams, **(streams or {})})
    if with_metrics or (with_metrics is None and state.metrics):
        after = cover(spark, store, after)
    store.publish(spark, after)
    return merge_newest(spark, store, replace(after, version=after.version + 1))


def refresh_metrics(spark: SparkSession, store: Store) -> State:
    """Brings the metrics up to the last run; builds them if there are none."""
    state = store.state(spark)
    if state.metrics and not any(state.uncovered(t) for t in ROWS):
        return state
    after = cover(spark, store, state)
    store.publish(spark, after)
    return merge_newest(spark, store, replace(after, version=after.version + 1))


def cover(spark: SparkSession, store: Store, state: State) -> State:
    """The state with metrics that cover all its rows: what the uncovered rows change is added.
    They are built from all rows if there are none, and again when the rows have grown so
    much that the history behind them needs more buckets."""
    run, sequence, targets = state.last.run_id, state.version + 1, store.targets
    size = sum(state.sizes[s][0] for t in ROWS for s in state.segments.get(t, ()))
    name = f"{run:012d}-{sequence:012d}"
    many = buckets_for(size) > state.history.get("buckets", 0)
    if not state.metrics or (many and size > REBUILD_GROWTH * state.history["bytes"]):
        rows = {t: targets[t].read(spark, state.segments.get(t, ())).drop(DAY) for t in ROWS}
        history = store.history(buckets_for(size))
        folder = store.metrics.write_build(rows["initial"], rows["changes"], by_row=True)
        written = history.write_build(spark, rows["initial"], rows["changes"], sequence, run)
        counts = quality.quality_totals(rows["initial"], rows["changes"]) if store.keep_quality else None
        old = store.tables(state).keys() - targets.keys()
        retired = [store.tables(state)[t].folder(s) for t in old for s in state.segments.get(t, ())]
        retired += [store.metrics.folder(f) for f in state.metrics.values()]
        kept = {t: s for t, s in state.segments.items() if t not in old}
        state = replace(
            state,
            segments=kept,
            retired=(*state.retired, *retired, *map(store.quality_folder, state.quality)),
            metrics={},
            history={"buckets": history.buckets, "bytes": size},
            quality=(),
        )
    else:
        late = {}
        for table in ROWS:
            names, target = state.uncovered(table), targets[table]
            rows = target.versions(spark, names).where(F.col(WRITTEN) > state.covered)
            several = len(names) > 1 or target.keep_versions
            rows = (target.newest(rows) if several else rows).select(*target.schema.fieldNames())
            late[table] = store_and_reload(rows, "late") if several else rows
        history = store.history(state.history["buckets"])
        entities, before, places = history.before(spark, state.segments, late["changes"], late["initial"])
        unplaced = history.unplaced(spark, state.segments, places)
        folder = store.metrics.write_touched(entities, before, unplaced, late["changes"], late["initial"])
        written = history.write_late(spark, places, late["changes"], late["initial"], sequence, run)
        counts = None
        if store.keep_quality:
            counts = changed_totals(entities, before.unionByName(unplaced), late["initial"], late["changes"])
    after = state.added(written, store.sizes(spark, state, written), run)
    if counts is not None:
        counts.write.parquet(store.quality_folder(name))
        after = replace(after, quality=(*after.quality, name))
    return replace(after, metrics={**state.metrics, name: folder}, covered=run)


def changed_totals(entities: DataFrame, changes: DataFrame, late_initial: DataFrame, late: DataFrame) -> DataFrame:
    """What new versions of rows do to the counts of the validation report; the first two are
    the stored rows of the licences that they touch."""
    new_entities = entities.join(late_initial.select("id"), "id", "left_anti").unionByName(late_initial)
    new_changes = changes.join(late.select("id"), "id", "left_anti").unionByName(late)
    after, before = quality.quality_totals(new_entities, new_changes), quality.quality_totals(entities, changes)
    both = after.unionByName(before.select(*[(-F.col(c)).alias(c) for c in before.columns]))
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def merge_newest(spark: SparkSession, store: Store, state: State) -> State:
    """Merges the newest segments of a table where so many are alike, and the deltas where there are many runs.
    Segments that this takes out of use are deleted by the next merge, so that a reader
    that has just begun still finds them."""
    counts = {t: newest_to_merge([state.sizes[s][0] for s in names]) for t, names in state.segments.items()}
    return _merged(spark, store, state, counts, len(state.metrics) > COMPACT_AFTER)


def compact(spark: SparkSession, store: Store, state: State) -> State:
    """Writes the segments of each table as one, and the deltas of all runs as one."""
    counts = {t: len(names) if len(names) > 1 else 0 for t, names in state.segments.items()}
    return _merged(spark, store, state, counts, len(state.metrics) > 1)


def _merged(spark: SparkSession, store: Store, state: State, counts: Mapping[str, int], deltas: bool) -> State:
    if not any(counts.values()) and not deltas:
        return state
    tables, segments, sizes, retired = store.tables(state), dict(state.segments), dict(state.sizes), []
    for table, count in counts.items():
        while count:
            names, target = segments[table], tables[table]
            kept, gone = names[:-count], names[-count:]
            merged = target.write_merged(spark, gone, state.version + 1, not kept)
            sizes[merged] = (target.bytes_of(spark, merged), max(sizes[s][1] for s in gone))
            segments[table] = (*kept, merged)
            retired += [target.folder(s) for s in gone]
            count = newest_to_merge([sizes[s][0] for s in segments[table]])
    metrics, counts = dict(state.metrics), state.quality
    if deltas:
        folder = store.metrics.write_merged(spark, metrics)
        retired += [store.metrics.folder(f) for f in metrics.values()]
        metrics = {max(metrics): folder}
        if len(counts) > 1:
            rows = spark.read.parquet(*map(store.quality_folder, counts))
            merged = f"{max(counts)}-{state.version + 1:012d}"
            rows.agg(*[F.sum(c).alias(c) for c in rows.columns]).write.parquet(store.quality_folder(merged))
            retired += map(store.quality_folder, counts)
            counts = (merged,)
    after = replace(state, segments=segments, sizes=sizes, retired=tuple(retired), metrics=metrics, quality=counts)
    store.publish(spark, after)
    for folder in state.retired:
        delete_path(spark, folder)
    return replace(after, version=after.version + 1)


def run_incremental(
    spark: SparkSession,
    initial: DataFrame,
    changes: DataFrame,
    store: Store,
    as_of: datetime | str,
    start: datetime | str | None = None,
    lookback: timedelta = timedelta(0),
    with_metrics: bool | None = None,
) -> Checkpoint:
    """One run over the event-time window [start or last processed, as_of].

    ``as_of`` stands for now.  Both bounds belong to the window, so the day of the
    watermark is read again; the upsert makes that harmless.  If the second table fails, the
    data watermark moves and the processed one does not, so the next run reads the
    window again; of a failed run no row is published.  Rows without a date are rejected
    and kept.  ``with_metrics`` begins the daily metrics of the store (``Store.mart``) or leaves them
    behind; without it a store that has metrics keeps them up to date.
    """
    state = store.state(spark)
    last = state.last
    end = as_utc(as_of)
    begin = (as_utc(start) if start is not None else last.last_processed) - lookback
    written: dict[str, str] = {}
    ranges, failure = [], None
    for table, source in {"initial": initial, "changes": changes}.items():
        target = store.targets[table]
        window = select_window(source, target.date_column, begin, end)
        undated = source.where(F.col(target.date_column).isNull())
        try:
            if failure is None:
                written |= write_batch(spark, store, table, window, state, None, undated)
        except Exception as error:  # raised again below, after the watermark is saved
            failure = error
        if failure is None:
            seen = event_range(spark, target, written[table])
        else:
            low, high = window.agg(F.min(target.date_column), F.max(target.date_column)).first()
            seen = None if low is None else tuple(as_utc(datetime(d.year, d.month, d.day)) for d in (low, high))
        if seen is not None:
            ranges.append((*seen, failure is None))
    if failure is not None:
        ranges = [(low, high, False) for low, high, _ in ranges]
    point = next_checkpoint(spark, last, ranges)
    if failure is not None:
        store.publish(spark, replace(state, runs=(*state.runs, point)))
        raise failure
    commit(spark, store, state, written, point, with_metrics=with_metrics)
    return point


def late_rows(spark: SparkSession, initial: DataFrame, changes: DataFrame, store: Store, since: datetime | str = EPOCH) -> DataFrame:
    """(table_name, id, event_day): rows that a run passes over, as their day is before the
    processed watermark and the store has no such id.  ``since`` bounds how far back the
    sources are read; rows without a key are rejected ones, not late ones."""
    state = store.state(spark)
    mark, first = state.last.last_processed.date(), as_utc(since).date()
    parts = []
    for name, source in {"initial": initial, "changes": changes}.items():
        target = store.targets[name]
        day = F.col(target.date_column).cast("date")
        older = source.where((day < F.lit(mark)) & (day >= F.lit(first)) & F.col(target.key).isNotNull())
        known = target.versions(spark, state.segments.get(name, ())).select(target.key).distinct()
        found = older.select(target.key, day.alias("event_day")).join(known, target.key, "left_anti")
        parts.append(found.select(F.lit(name).alias("table_name"), F.col(target.key).alias("id"), "event_day"))
    return parts[0].unionByName(parts[1])


def backfill_span(late: DataFrame, as_of: datetime | str) -> DataFrame:
    """(table_name, n_late, first_day, last_day, days): how many days back from ``as_of`` a
    backfill has to start to bring all late rows."""
    spans = late.groupBy("table_name").agg(
        F.count("*").alias("n_late"), F.min("event_day").alias("first_day"), F.max("event_day").alias("last_day")
    )
    return spans.withColumn("days", F.date_diff(F.lit(as_utc(as_of).date()), F.col("first_day")).cast("long") + 1)


def next_checkpoint(spark: SparkSession, last: Checkpoint, ranges: list[tuple[datetime, datetime, bool]]) -> Checkpoint:
    """Watermarks after batches of (first event, last event, succeeded)."""
    batches = spark.createDataFrame(ranges, "min_event timestamp, max_event timestamp, succeeded boolean")
    moved = advance_watermarks(batches, F.lit(last.last_data), F.lit(last.last_processed))
    data, processed = moved.select(
        F.unix_micros("last_data_timestamp"), F.unix_micros("last_processed_timestamp")
    ).first()
    return Checkpoint(last.run_id + 1, _time(data), _time(processed))


def run_backfill(
    spark: SparkSession,
    initial: DataFrame,
    changes: DataFrame,
    store: Store,
    as_of: datetime | str,
    days: int | None = BACKFILL_DAYS,
    with_metrics: bool | None = None,
) -> Checkpoint:
    """Read the last ``days`` days again, which picks up rows that came late; with None as many
    days as the late rows need."""
    end = as_utc(as_of)
    if days is None:
        days = backfill_span(late_rows(spark, initial, changes, store), end).agg(F.max("days")).first()[0] or 0
    begin = end - timedelta(days=days)
    return run_incremental(spark, initial, changes, store, end, start=begin, with_metrics=with_metrics)
