from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import history, metrics, upsert
from tallyspan.plans import incremental as inc
from tallyspan.plans.metrics import license_metrics
from tallyspan.session import scratch_path
from tallyspan.sources import files
from tallyspan.sources.pointer import Conflict

D = date.fromisoformat


def log(days, start=0, price=100):
    return [(start + i, i % 3, D(day), price, "PASS", True) for i, day in enumerate(days)]


def content(store, spark):
    return sorted((r.id, str(r.date), r.price) for r in store.rows(spark, "changes").collect())


@pytest.fixture
def store(spark):
    return inc.Store(scratch_path(spark, "store"))


@pytest.fixture
def tables(initial_of, changes_of):
    initial = initial_of([(i, i, "PASS", D("2024-01-01"), 100, True) for i in range(3)])
    changes = changes_of(log(["2024-01-05", "2024-01-20", "2024-02-03", "2024-02-28", "2024-03-15", "2024-04-01"]))
    return initial, changes


def test_first_run_on_an_empty_store(spark, store, tables):
    point = inc.run_incremental(spark, *tables, store, "2024-02-28T12:00:00")
    assert point == inc.load_checkpoint(spark, store)
    assert point.last_processed == datetime(2024, 2, 28, tzinfo=timezone.utc)
    assert [r[0] for r in content(store, spark)] == [0, 1, 2, 3]


def test_runs_in_steps_equal_one_run(spark, store, tables):
    for as_of in ("2024-01-10", "2024-02-10", "2024-05-01", "2024-05-01"):
        inc.run_incremental(spark, *tables, store, as_of)
    other = inc.Store(scratch_path(spark, "store"))
    inc.run_incremental(spark, *tables, other, "2024-05-01")
    assert content(store, spark) == content(other, spark)
    assert inc.load_checkpoint(spark, store).run_id == 4


def test_empty_window_changes_nothing(spark, store, tables):
    inc.run_incremental(spark, *tables, store, "2024-05-01")
    before = content(store, spark)
    empty = tuple(t.limit(0) for t in tables)
    point = inc.run_incremental(spark, *empty, store, "2024-06-01")
    assert content(store, spark) == before
    assert point.last_processed == datetime(2024, 4, 1, tzinfo=timezone.utc)


def test_late_row_needs_a_backfill(spark, store, tables, changes_of):
    initial, changes = tables
    inc.run_incremental(spark, initial, changes, store, "2024-04-01")
    grown = changes.unionByName(changes_of(log(["2024-03-30", "2024-01-06"], start=50)))
    inc.run_incremental(spark, initial, grown, store, "2024-04-02")
    assert [r[0] for r in content(store, spark)] == [0, 1, 2, 3, 4, 5]
    inc.run_backfill(spark, initial, grown, store, "2024-04-02")
    assert [r[0] for r in content(store, spark)] == [0, 1, 2, 3, 4, 5, 50]
    inc.run_backfill(spark, initial, grown, store, "2024-04-02", days=120)
    assert [r[0] for r in content(store, spark)] == [0, 1, 2, 3, 4, 5, 50, 51]


def test_lookback_reads_older_days(spark, store, tables, changes_of):
    initial, changes = tables
    inc.run_incremental(spark, initial, changes, store, "2024-04-01")
    grown = changes.unionByName(changes_of(log(["2024-03-31"], start=50)))
    inc.run_incremental(spark, initial, grown, store, "2024-04-01", lookback=timedelta(hours=24))
    assert 50 in [r[0] for r in content(store, spark)]


def commit(spark, store, rows):
    state = store.state(spark)
    written = inc.write_batch(spark, store, "changes", rows, state)
    return inc.commit(spark, store, state, written, inc.next_checkpoint(spark, state.last, []))


def test_moved_row_leaves_its_old_day(spark, store, tables, changes_of):
    inc.run_incremental(spark, *tables, store, "2024-05-01")
    moved = changes_of([(5, 2, D("2024-02-10"), 700, "SIM", True), (2, 2, D("2024-03-01"), 800, "SIM", True)])
    after = commit(spark, store, moved)
    got = {r[0]: r[1:] for r in content(store, spark)}
    assert len(got) == 6 and got[5] == ("2024-02-10", 700) and got[2] == ("2024-03-01", 800)
    days = {r.event_day for r in store.read(spark, "changes").collect()}
    assert "2024-04-01" not in days and {"2024-02-10", "2024-03-01"} <= days
    assert store.targets["changes"].touched_days(spark, after.segments["changes"][-1]) == ["2024-02-10", "2024-03-01"]


def test_rows_without_a_date_are_kept(spark, store, changes_of):
    rows = log(["2024-01-05", "2024-02-05"]) + [(7, 1, None, 1, "SIM", True)]
    commit(spark, store, changes_of(rows))
    assert (7, "None", 1) in content(store, spark)
    commit(spark, store, changes_of([(7, 1, D("2024-02-07"), 1, "SIM", True)]))
    assert [(r[0], r[1]) for r in content(store, spark)] == [(0, "2024-01-05"), (1, "2024-02-05"), (7, "2024-02-07")]


def test_rows_without_a_key_are_kept_once(spark, store, tables, changes_of):
    initial, changes = tables
    lost = [(None, 1, D("2024-01-06"), 5, "SIM", True)] * 3 + [(None, 1, D("2024-01-06"), None, "", True)]
    lost += [(None, 1, D("2024-01-06"), None, None, True)]
    both = changes.unionByName(changes_of(lost))
    for _ in range(3):
        inc.run_incremental(spark, initial, both, store, "2024-05-01", start="2023-01-01")
        assert len(content(store, spark)) == 6
        kept = store.rows(spark, "rejected_changes").drop("content").collect()
        assert sorted(map(tuple, kept), key=str) == sorted(lost, key=str)


def files_of(path):
    return {p: p.stat().st_size for p in Path(path).rglob("*") if p.is_file() and not p.name.startswith((".", "_"))}


def test_one_row_costs_one_file(spark, store, tables, changes_of):
    """What a batch writes does not depend on what is stored, and nothing stored is read."""
    inc.run_incremental(spark, *tables, store, "2024-05-01")
    before = files_of(store.root)
    one = changes_of([(5, 2, D("2024-02-10"), 700, "SIM", True)])
    for path in before:  # unreadable from here on: a commit that read them would fail
        if path.suffix == ".parquet":
            path.chmod(0)
    plan_free = commit(spark, store, one)
    added = {p: n for p, n in files_of(store.root).items() if p not in before}
    assert sorted(p.suffix for p in added) == [".json", ".parquet"]
    assert sum(n for p, n in added.items() if p.suffix == ".parquet") < 5000
    assert len(plan_free.segments["changes"]) == 2


def test_pointer_stays_small_and_segments_are_merged(spark, store, changes_of):
    for i in range(inc.COMPACT_AFTER + 3):
        after = commit(spark, store, changes_of([(i % 5, 1, D("2024-01-05"), i, "SIM", True)]))
    assert len(after.segments["changes"]) <= inc.COMPACT_AFTER
    assert sorted(r[2] for r in content(store, spark)) == list(range(inc.COMPACT_AFTER - 2, inc.COMPACT_AFTER + 3))
    assert len(files_of(f"{store.root}/state")) == 2


def test_run_that_stops_before_it_publishes_leaves_no_trace(spark, store, tables, monkeypatch):
    inc.run_incremental(spark, *tables, store, "2024-02-10")
    before, point = content(store, spark), inc.load_checkpoint(spark, store)
    with monkeypatch.context() as patch:
        patch.setattr(inc.Store, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            inc.run_incremental(spark, *tables, store, "2024-05-01")
    assert content(store, spark) == before
    assert inc.load_checkpoint(spark, store) == point
    inc.run_incremental(spark, *tables, store, "2024-05-01")
    assert len(content(store, spark)) == 6


def test_two_runs_at_once_are_told_apart(spark, store, tables):
    inc.run_incremental(spark, *tables, store, "2024-02-10")
    state = store.state(spark)
    store.publish(spark, state)
    with pytest.raises(Conflict):
        store.publish(spark, state)


def test_failed_run_moves_only_the_data_watermark(spark, store, tables, monkeypatch):
    inc.run_incremental(spark, *tables, store, "2024-02-10")
    with monkeypatch.context() as patch:
        patch.setattr(inc, "write_batch", lambda *_: (_ for _ in ()).throw(RuntimeError("no space")))
        with pytest.raises(RuntimeError):
            inc.run_incremental(spark, *tables, store, "2024-03-20")
    point = inc.load_checkpoint(spark, store)
    assert point.last_data == datetime(2024, 3, 15, tzinfo=timezone.utc)
    assert point.last_processed == datetime(2024, 2, 3, tzinfo=timezone.utc)
    inc.run_incremental(spark, *tables, store, "2024-03-20")
    assert [r[0] for r in content(store, spark)] == [0, 1, 2, 3, 4]
    assert inc.load_checkpoint(spark, store).last_processed == datetime(2024, 3, 15, tzinfo=timezone.utc)


def test_runs_keep_the_metrics(spark, store, tables, changes_of, initial_of):
    initial, changes = tables
    inc.run_incremental(spark, initial, changes, store, "2024-02-10", with_metrics=True)
    inc.run_incremental(spark, initial, changes, store, "2024-05-01", with_metrics=True)
    # new versions: another licence, another day, another type; an entity moves
    late = changes_of([(1, 2, D("2024-01-21"), 100, "PASS", False), (5, 2, D("2024-03-20"), 1, "SIM", True)])
    entity = initial_of([(1, 1, "SIM", D("2023-12-20"), 1000, True)])
    inc.run_incremental(spark, entity, late, store, "2024-05-01", start="2023-01-01", with_metrics=True)
    full = license_metrics(store.rows(spark, "initial"), store.rows(spark, "changes"))
    assert sorted(map(tuple, store.mart(spark).collect())) == sorted(map(tuple, full.collect()))
    merged = inc.compact(spark, store, store.state(spark))
    assert len(merged.metrics) == 1
    assert sorted(map(tuple, store.mart(spark).collect())) == sorted(map(tuple, full.collect()))


def test_a_new_version_replaces_the_old_one(initial_of, changes_of):
    initial = initial_of([(1, 1, "PASS", D("2024-01-02"), 100, True), (2, 1, "PASS", D("2024-01-02"), 100, True)])
    known = changes_of([(1, 1, D("2024-01-06"), 5000, "SUPERVISION", True), (2, 1, D("2024-01-09"), 1, "SIM", True)])
    late = changes_of([(1, 2, D("2024-01-05"), 100, "PASS", True), (2, 1, D("2024-01-08"), 2, "SIM", True)])
    deltas = metrics.interval_deltas(history.state_intervals(initial, known, keep_hidden=True))
    got = upsert.recompute_affected(deltas, initial, known, late)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, license_metrics(initial, late).collect()))


def test_upsert_is_idempotent_and_newest_row_wins(changes_of):
    target = changes_of(log(["2024-01-01", "2024-01-02"]))
    incoming = changes_of([(1, 1, D("2024-01-03"), 5, "SIM", True), (1, 1, D("2024-01-04"), 6, "SIM", True), (9, 1, D("2024-01-04"), 7, "SIM", True)])
    newest = [F.col("date").desc()]
    once = upsert.upsert(target, incoming, "id", newest)
    twice = upsert.upsert(once, incoming, "id", newest)
    rows = sorted(map(tuple, once.collect()))
    assert rows == sorted(map(tuple, twice.collect()))
    assert [(r[0], r[3]) for r in rows] == [(0, 100), (1, 6), (9, 7)]
    assert sorted(map(tuple, upsert.upsert(target, incoming.limit(0), "id", newest).collect())) == sorted(map(tuple, target.collect()))


def test_window_bounds_are_inclusive_midnights(changes_of):
    df = changes_of(log(["2024-01-01", "2024-01-02", "2024-01-03"]))

    def ids(start, end):
        got = upsert.select_window(df, "date", datetime.fromisoformat(start), datetime.fromisoformat(end))
        return sorted(r.id for r in got.collect())

    assert ids("2024-01-01", "2024-01-02") == [0, 1]
    assert ids("2024-01-01T00:00:01", "2024-01-02T23:59:00") == [1]
    assert ids("2024-01-02T10:00:00", "2024-01-03T00:00:00") == [2]


def test_window_reaches_the_scan(spark, tmp_path, changes_of):
    changes_of(log(["2024-01-01", "2024-01-02"])).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    got = upsert.select_window(stored, "date", datetime(2024, 1, 2), datetime(2024, 1, 3))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2024-01-02)" in plan and "LessThanOrEqual(date,2024-01-03)" in plan


def test_watermarks_hold_at_the_first_failed_batch(spark):
    rows = [(D("2024-01-01"), D("2024-01-09"), True), (D("2024-01-10"), D("2024-01-19"), False), (D("2024-01-20"), D("2024-01-29"), True)]
    batches = spark.createDataFrame(rows, "min_event date, max_event date, succeeded boolean")
    old = F.lit(D("2023-12-01"))
    got = upsert.advance_watermarks(batches, old, old).first()
    assert tuple(got) == (D("2024-01-29"), D("2024-01-10"), 1)
    later = F.lit(D("2025-01-01"))
    assert tuple(upsert.advance_watermarks(batches, later, later).first())[:2] == (D("2025-01-01"), D("2025-01-01"))
    assert tuple(upsert.advance_watermarks(batches.limit(0), old, old).first()) == (D("2023-12-01"), D("2023-12-01"), 0)


def test_timestamps_must_be_utc():
    assert upsert.as_utc("2024-01-01T10:00:00") == datetime(2024, 1, 1, 10, tzinfo=timezone.utc)
    with pytest.raises(ValueError):
        upsert.as_utc("2024-01-01T10:00:00+02:00")


def test_late_rows_correct_the_stored_deltas(initial_of, changes_of):
    initial = initial_of([(1, 1, "PASS", D("2024-01-02"), 100, True), (2, 1, "SIM", D("2024-01-03"), 1000, True)])
    known = changes_of([(1, 2, D("2024-01-06"), 5000, "SUPERVISION", True)])
    # one removes the only SUPERVISION interval, one brings a new type, one widens the calendar
    late = changes_of(
        [(9, 2, D("2024-01-06"), 1000, "SIM", False), (5, 1, D("2024-01-04"), 7, "NEW", True), (6, 3, D("2024-01-12"), 1, "SIM", True)]
    )
    deltas = metrics.interval_deltas(history.state_intervals(initial, known, keep_hidden=True))
    got = upsert.recompute_affected(deltas, initial, known, late)
    full = license_metrics(initial, known.unionByName(late))
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(map(tuple, full.collect()))
    assert {r[1] for r in rows} == {"PASS", "SIM", "NEW"}


def test_late_entities_correct_the_stored_deltas(initial_of, changes_of):
    initial = initial_of([(1, 1, "PASS", D("2024-01-02"), 100, True)])
    known = changes_of([(1, 2, D("2024-01-06"), 5000, "SUPERVISION", True)])  # an orphan until its entity arrives
    late_initial = initial_of([(2, 1, "SIM", D("2023-12-30"), 1000, True), (1, 1, "SIM", D("2024-01-01"), 5, True)])
    late = changes_of([])
    deltas = metrics.interval_deltas(history.state_intervals(initial, known, keep_hidden=True))
    got = upsert.recompute_affected(deltas, initial, known, late, late_initial)
    full = license_metrics(initial.unionByName(late_initial), known)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))


def test_csv_reader_is_strict(spark, tmp_path, changes_of):
    rows = log(["2024-01-01", "2024-01-02"])
    files.write_csv(changes_of(rows), str(tmp_path / "good"))
    back = files.read_csv(spark, str(tmp_path / "good"), changes_of([]).schema)
    assert sorted(map(tuple, back.collect())) == rows
    timed = files.read_csv_utc(spark, str(tmp_path / "good"), changes_of([]).schema, "date")
    assert dict(timed.dtypes)["date"] == "timestamp" and timed.count() == 2
    (tmp_path / "bad.csv").write_text("id,license_id,date,price,type,renewable\n1,2,not a date,3,PASS,True\n")
    with pytest.raises(Exception, match="(?i)malformed|failfast|parse"):
        files.read_csv(spark, str(tmp_path / "bad.csv"), changes_of([]).schema).collect()


def test_gate_preview_and_table(spark, tables):
    _, changes = tables
    files.require_min_rows(changes, 6)
    with pytest.raises(ValueError):
        files.require_min_rows(changes, 7)
    assert files.preview(changes, 4).count() == 4
    files.replace_table(changes.withColumn("date", F.col("date").cast("timestamp")), "license_changes_t", "date")
    files.replace_table(changes.withColumn("date", F.col("date").cast("timestamp")), "license_changes_t", "date")
    assert spark.table("license_changes_t").count() == 6
    assert dict(spark.table("license_changes_t").dtypes)["date"] == "date"
    spark.sql("DROP TABLE license_changes_t")


def full_mart(spark, store):
    full = license_metrics(store.rows(spark, "initial"), store.rows(spark, "changes"))
    return sorted(map(tuple, full.collect()), key=str)


def stored_mart(spark, store):
    return sorted(map(tuple, store.mart(spark).collect()), key=str)


def test_metrics_take_up_what_runs_without_them_brought(spark, store, tables, changes_of):
    initial, changes = tables
    inc.run_incremental(spark, initial, changes, store, "2024-02-10", with_metrics=True)
    assert stored_mart(spark, store) == full_mart(spark, store)
    # without: a row of licence 1 moves to licence 2, and new rows
    moved = changes_of([(1, 2, D("2024-02-12"), 7, "SIM", False)])
    inc.run_incremental(spark, initial, changes.unionByName(moved), store, "2024-03-20", with_metrics=False)
    with pytest.raises(inc.StaleMetrics):
        store.mart(spark)
    # the next run keeps them without being asked
    inc.run_incremental(spark, initial, changes, store, "2024-05-01")
    assert stored_mart(spark, store) == full_mart(spark, store)
    for day, price in (("2024-02-14", 8), ("2024-02-15", 9)):
        again = changes_of([(1, 0, D(day), price, "PASS", True)])
        inc.run_incremental(spark, initial.limit(0), again, store, "2024-05-01", start="2023-01-01", with_metrics=False)
    inc.refresh_metrics(spark, store)
    assert stored_mart(spark, store) == full_mart(spark, store)
    assert inc.refresh_metrics(spark, store).version == store.state(spark).version


def test_a_correction_reads_the_buckets_that_it_touches(spark, store, initial_of, changes_of):
    initial = initial_of([(i, i, "PASS", D("2024-01-01"), 100, True) for i in range(200)])
    changes = changes_of([(i, i % 200, D("2024-01-05") + timedelta(days=i % 50), 100, "SIM", i % 3 > 0) for i in range(2000)])
    inc.run_incremental(spark, initial, changes, store, "2024-05-01", with_metrics=True)
    state = store.state(spark)
    history = store.history(state.history["buckets"])
    late = changes_of([(77, 5, D("2024-01-09"), 9, "PASS", True)])  # licence 77 had it
    one = {c: {r[0] for r in late.select(history.tables[t].bucket_of(c)).collect()} for t, c in (("history_places", "id"), ("history_changes", "license_id"))}
    own = spark.createDataFrame([(77,)], "license_id long").select(history.tables["history_changes"].bucket_of("license_id")).first()[0]
    allowed = {"places": one["id"], "changes": one["license_id"] | {own}, "entities": one["license_id"] | {own}}
    closed = kept = 0
    for path in files_of(store.root):
        if path.suffix == ".parquet" and "history" in str(path):
            table, bucket = path.parts[-4], int(path.parent.name.removeprefix("bucket="))
            if bucket in allowed[table]:
                kept += path.stat().st_size
            else:
                closed += path.stat().st_size
                path.chmod(0)  # a run that read it would fail
        elif path.suffix == ".parquet":
            path.chmod(0)
    inc.run_incremental(spark, initial.limit(0), late, store, "2024-05-01", start="2024-01-01")
    assert 0 < kept < 0.4 * closed
    for path in files_of(store.root):
        path.chmod(0o644)
    assert stored_mart(spark, store) == full_mart(spark, store)


def test_random_runs_keep_the_metrics(spark, store, initial_of, changes_of, monkeypatch):
    """Moves between licences, gaps, merges and rebuilt buckets, against one computation."""
    import random

    from tallyspan.plans import history_store
    from tallyspan.sources import targets

    monkeypatch.setattr(targets, "FAN", 3)
    monkeypatch.setattr(inc, "REBUILD_GROWTH", 1.2)
    monkeypatch.setattr(history_store, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(history_store, "LEAST_BUCKETS", 2)
    rng = random.Random(5)
    initial = initial_of([(i, i, "PASS", D("2024-01-03") + timedelta(days=i % 4), 100, True) for i in range(12)])
    buckets = set()
    for step in range(6):
        rows = []
        for _ in range([4, 30, 1, 9, 30, 4][step]):
            day = D("2024-01-01") + timedelta(days=rng.randrange(40))
            rows.append((rng.randrange(60), rng.randrange(14), day, rng.randrange(9), rng.choice(["A", "B", None]), rng.choice([True, False, None])))
        batch = changes_of(list({r[0]: r for r in rows}.values()))
        entities = initial if step in (0, 4) else initial_of([(rng.randrange(14), 1, "B", D("2024-01-02"), 5, True)])
        inc.run_incremental(spark, entities, batch, store, "2024-05-01", start="2023-01-01", with_metrics=step not in (2, 3))
        buckets.add(store.state(spark).history["buckets"])
        if step in (1, 5):
            assert stored_mart(spark, store) == full_mart(spark, store)
    assert len(buckets) > 1


def test_a_large_segment_is_left_alone():
    """Bytes written again by 1000 small commits behind a large segment."""
    from tallyspan.sources.targets import FAN, newest_to_merge

    sizes, rewritten, most = [10 << 30], 0, 0
    for _ in range(1000):
        sizes.append(1_700)
        while count := newest_to_merge(sizes):
            rewritten += sum(sizes[-count:])
            sizes[-count:] = [sum(sizes[-count:])]
        most = max(most, len(sizes))
    assert sizes[0] == 10 << 30
    assert rewritten < 12 * 1000 * 1_700 * 4 and most <= 1 + 4 * FAN


def test_small_runs_do_not_rewrite_what_is_stored(spark, store, tables, changes_of, monkeypatch):
    from tallyspan.sources import targets

    monkeypatch.setattr(targets, "LEAST_BYTES", 4000)
    many = changes_of([(1000 + i, i % 3, D("2024-01-05"), i, "PASS", True) for i in range(20_000)])
    inc.run_incremental(spark, tables[0], many, store, "2024-05-01")
    first = store.state(spark).segments["changes"][0]
    monkeypatch.setattr(targets, "FAN", 4)
    for i in range(10):
        after = commit(spark, store, changes_of([(i % 4, 1, D("2024-01-05"), i, "SIM", True)]))
    assert after.segments["changes"][0] == first and len(after.segments["changes"]) <= 1 + 2 * targets.FAN
    got = content(store, spark)
    assert len(got) == 20_004 and sorted(r[2] for r in got if r[0] < 4) == list(range(6, 10))


def test_undated_rows_are_kept_and_counted(spark, store, tables, changes_of):
    initial, changes = tables
    odd = [(80, 1, None, 5, "SIM", True), (None, 1, None, 5, "SIM", True), (81, 1, None, None, None, None), (None, 1, D("2024-01-06"), 5, "SIM", True)]
    for _ in range(2):
        inc.run_incremental(spark, initial, changes.unionByName(changes_of(odd)), store, "2024-05-01", start="2023-01-01")
    kept = store.rows(spark, "rejected_changes").drop("content").collect()
    assert sorted(map(tuple, kept), key=str) == sorted(odd, key=str)
    assert sorted(map(tuple, inc.rejected_report(spark, store).collect())) == [("changes", "no date", 2), ("changes", "no key", 2)]
    assert len(content(store, spark)) == 6


def test_late_rows_are_named_with_the_days_that_they_need(spark, store, tables, changes_of):
    initial, changes = tables
    inc.run_incremental(spark, initial, changes, store, "2024-04-01")
    assert inc.late_rows(spark, initial, changes, store).collect() == []
    grown = changes.unionByName(changes_of(log(["2024-03-30", "2024-01-06", "2024-04-09"], start=50) + [(None, 1, D("2024-01-02"), 1, "SIM", True)]))
    late = inc.late_rows(spark, initial, grown, store)
    assert sorted((r.table_name, r.id, str(r.event_day)) for r in late.collect()) == [("changes", 50, "2024-03-30"), ("changes", 51, "2024-01-06")]
    assert [r.id for r in inc.late_rows(spark, initial, grown, store, since="2024-02-01").collect()] == [50]
    span = inc.backfill_span(late, "2024-04-02").first()
    assert (span.n_late, str(span.first_day), str(span.last_day), span.days) == (2, "2024-01-06", "2024-03-30", 88)
    inc.run_backfill(spark, initial, grown, store, "2024-04-02", days=None)
    assert [r[0] for r in content(store, spark)] == [0, 1, 2, 3, 4, 5, 50, 51]


def test_rows_of_an_older_run(spark, tables, changes_of, monkeypatch):
    from tallyspan.operators.bitemporal import asof_known_at
    from tallyspan.sources import targets

    monkeypatch.setattr(targets, "FAN", 2)
    store = inc.Store(scratch_path(spark, "store"), keep_versions=True)
    inc.run_incremental(spark, *tables, store, "2024-05-01")
    inc.run_incremental(spark, tables[0].limit(0), changes_of([(0, 0, D("2024-01-05"), 900, "SIM", True)]), store, "2024-05-01", start="2023-01-01")
    inc.run_incremental(spark, tables[0].limit(0), changes_of([(0, 2, D("2024-01-06"), 901, "SIM", True)]), store, "2024-05-01", start="2023-01-01")
    assert len(store.state(spark).segments["changes"]) < 3  # merged, and still all there
    price = {run: {r.id: r.price for r in store.rows_at(spark, "changes", run).collect()}.get(0) for run in range(4)}
    assert price == {0: None, 1: 100, 2: 900, 3: 901}
    assert sorted(r.price for r in store.rows(spark, "changes").where("id = 0").collect()) == [901]
    points = spark.createDataFrame(
        [(i, lic, D(day), run) for i, (lic, day, run) in enumerate((lic, day, run) for lic in (0, 2) for day in ("2024-01-05", "2024-01-07") for run in (0, 1, 2, 3))],
        "point_id long, license_id long, date date, run_id long",
    )
    found = asof_known_at(points, store.versions(spark, "initial"), store.versions(spark, "changes"), "point_id")
    assert found.columns[:4] == points.columns
    got = {(r.license_id, str(r.date), r.run_id): r.price for r in found.collect()}
    first = {(0, "2024-01-05"): [None, 100, 900, 100], (0, "2024-01-07"): [None, 100, 900, 100], (2, "2024-01-05"): [None, 100, 100, 100], (2, "2024-01-07"): [None, 100, 100, 901]}
    assert got == {(*k, run): v for k, vs in first.items() for run, v in enumerate(vs)}
    with pytest.raises(ValueError):
        inc.Store(store.root).rows_at(spark, "changes", 1)


def test_a_row_leaves_no_day_behind_without_a_licence(spark, store, tables, changes_of):
    """Two rows without a licence on the last day: the calendar keeps it until both are gone."""
    initial, changes = tables
    lost = changes_of([(70, None, D("2024-06-01"), 1, "SIM", True), (71, None, D("2024-06-01"), 1, "SIM", True)])
    inc.run_incremental(spark, initial, changes.unionByName(lost), store, "2024-07-01", with_metrics=True)
    for number, last in ((70, "2024-06-01"), (71, "2024-04-01")):
        placed = changes_of([(number, 1, D("2024-03-01"), 1, "SIM", True)])
        inc.run_incremental(spark, initial.limit(0), placed, store, "2024-07-01", start="2023-01-01")
        assert stored_mart(spark, store) == full_mart(spark, store)
        assert str(store.mart(spark).agg(F.max("date")).first()[0]) == last
