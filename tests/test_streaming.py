from __future__ import annotations

import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyspan.plans import incremental as inc
from tallyspan.session import scratch_path
from tallyspan.streaming import changes as st

D = date.fromisoformat
SCHEMA = "id long, ts timestamp, type string"


@pytest.fixture
def feed(spark, tmp_path):
    """A folder to which each call adds one file, in arrival order."""
    folder, count = tmp_path / "feed", [0]
    folder.mkdir()

    def add(rows, schema=SCHEMA):
        count[0] += 1
        part = str(tmp_path / f"part{count[0]}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(part)
        source = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        target = folder / f"{count[0]:03d}.parquet"
        target.write_bytes((tmp_path / f"part{count[0]}" / source).read_bytes())
        os.utime(target, (1_700_000_000 + count[0], 1_700_000_000 + count[0]))

    add.path = str(folder)
    return add


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def stream_of(spark, feed):
    from pyspark.sql.types import _parse_datatype_string

    return st.read_stream(spark, feed.path, _parse_datatype_string(SCHEMA), files_per_batch=1)


def test_rows_behind_the_watermark_are_dropped(spark, feed, tmp_path):
    feed([(1, at("2024-01-01"), "A"), (1, at("2024-01-01"), "A")])
    feed([(2, at("2024-01-10"), "A"), (3, at("2024-01-09"), "A")])
    feed([(2, at("2024-01-10"), "A")])  # a batch's late rows are those behind the watermark before it
    feed([(4, at("2024-01-01"), "A"), (2, at("2024-01-10"), "A"), (5, at("2024-01-09T12:00:00"), "B")])
    once = st.dedup_stream(stream_of(spark, feed), "id", "ts", "2 days")
    st.run_to_parquet(once, str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 5]


def test_updates_keep_the_last_count_and_survive_a_restart(spark, feed, tmp_path):
    feed([(1, at("2024-01-01T01:00:00"), "A"), (2, at("2024-01-01T23:59:59"), "A"), (3, at("2024-01-02"), "B")])
    feed([(4, at("2024-01-01T05:00:00"), "A")])

    def run():
        counts = st.daily_counts_stream(stream_of(spark, feed), "ts", "type", "5 days")
        st.run_updates(counts, str(tmp_path / "out"), str(tmp_path / "state"))
        final = st.latest_updates(spark.read.parquet(str(tmp_path / "out")), ["date", "type"])
        return sorted((str(r.date), r.type, r.n_changes) for r in final.collect())

    assert run() == [("2024-01-01", "A", 3), ("2024-01-02", "B", 1)]
    feed([(5, at("2024-01-02T12:00:00"), "B")])
    assert run() == [("2024-01-01", "A", 3), ("2024-01-02", "B", 2)]


def test_stream_upsert_replays_do_no_harm(spark, tmp_path, changes_of):
    schema = changes_of([]).schema
    folder = str(tmp_path / "log")
    first = [(i, 1, D("2024-01-01"), 100, "PASS", True) for i in range(4)]
    second = [(2, 1, D("2024-02-01"), 200, "SIM", True), (7, 1, D("2024-01-15"), 300, "SIM", False)]
    store = inc.Store(scratch_path(spark, "store"))

    def run(state):
        st.run_upserts(st.read_stream(spark, folder, schema, 1), store, state)
        return sorted((r.id, str(r.date), r.price) for r in store.rows(spark, "changes").collect())

    changes_of(first).coalesce(1).write.parquet(folder)
    run(str(tmp_path / "state"))
    changes_of(second).coalesce(1).write.mode("append").parquet(folder)
    expected = [(0, "2024-01-01", 100), (1, "2024-01-01", 100), (2, "2024-02-01", 200), (3, "2024-01-01", 100), (7, "2024-01-15", 300)]
    assert run(str(tmp_path / "state")) == expected
    # the same batches again, of this stream and then as another one, and after a run
    runs = inc.load_checkpoint(spark, store).run_id
    name = st.stream_id(spark, str(tmp_path / "state"))
    st.run_upserts(st.read_stream(spark, folder, schema, 1), store, str(tmp_path / "again"), source_id=name)
    assert inc.load_checkpoint(spark, store).run_id == runs
    assert run(str(tmp_path / "other")) == expected
    assert inc.load_checkpoint(spark, store).run_id == runs + 2
    assert store.checkpoints(spark).select(F.max(F.to_date("last_data_timestamp"))).first()[0] == D("2024-02-01")


def test_a_run_does_not_hide_a_stream(spark, tmp_path, initial_of, changes_of):
    store = inc.Store(scratch_path(spark, "store"))
    inc.run_incremental(spark, initial_of([]), changes_of([(1, 1, D("2024-01-01"), 100, "PASS", True)]), store, "2024-05-01")
    for number in (2, 3):
        folder = str(tmp_path / f"log{number}")
        changes_of([(number, 1, D("2024-01-02"), 100, "PASS", True)]).coalesce(1).write.parquet(folder)
        stream = st.read_stream(spark, folder, changes_of([]).schema, 1)
        st.run_upserts(stream, store, str(tmp_path / f"state{number}"))
    assert sorted(r.id for r in store.rows(spark, "changes").collect()) == [1, 2, 3]


def test_live_metrics_equal_one_computation(spark, tmp_path, initial_of, changes_of):
    """Gaps, rows without a licence, changes before their entity, restarts and replays."""
    from tallyspan.plans.metric_store import MetricStore
    from tallyspan.plans.metrics import license_metrics
    from tallyspan.streaming import live
    from tests.test_metrics import random_tables

    initial, changes = random_tables(31, gaps=True)
    changes += [(900, None, D("2023-12-20"), 1, "SIM", True), (901, 99, D("2024-06-01"), 1, "SIM", True)]
    stored = MetricStore(scratch_path(spark, "metrics"))
    folders = [str(tmp_path / n) for n in ("entities", "changes")]
    parts = [(initial[:4], changes[1::2]), (initial[4:], changes[::4]), ([], changes)]
    for entities, rows in parts:
        initial_of(entities).coalesce(1).write.mode("append").parquet(folders[0])
        changes_of(rows).coalesce(1).write.mode("append").parquet(folders[1])
        streams = [st.read_stream(spark, f, of([]).schema) for f, of in zip(folders, (initial_of, changes_of))]
        live.run_live_mart(*streams, stored, str(tmp_path / "state"))
    got = sorted((tuple(r) for r in stored.mart(spark).collect()), key=str)
    assert got == sorted((tuple(r) for r in license_metrics(initial_of(initial), changes_of(changes)).collect()), key=str)


def test_live_state_is_a_value_per_bucket(spark, tmp_path, initial_of, changes_of):
    """Many licences are few values of the state, also after a restart that names another number."""
    from tallyspan.plans.metric_store import MetricStore
    from tallyspan.plans.metrics import license_metrics
    from tallyspan.streaming import live

    day = lambda n: date.fromordinal(D("2024-01-01").toordinal() + n)
    kinds = ("PASS", "SIM", None)
    initial = [(i, i % 40, kinds[i % 3], day(i % 9), 100 + i if i % 4 else None, True) for i in range(300)]
    changes = [(k, k % 320 if k % 50 else None, day(k % 23), k if k % 6 else None, kinds[k % 3], (True, False, None)[k % 7 % 3]) for k in range(900)]
    changes += [(10_000, 5, day(3), 2**60 + 1, "SIM", True)]  # no double holds it
    stored, state = MetricStore(scratch_path(spark, "metrics")), str(tmp_path / "state")
    folders = [str(tmp_path / n) for n in ("entities", "changes")]
    for entities, rows, buckets in ((initial[::2], changes[::3], 7), (initial[1::2], changes, 50)):
        initial_of(entities).coalesce(1).write.mode("append").parquet(folders[0])
        changes_of(rows).coalesce(1).write.mode("append").parquet(folders[1])
        streams = [st.read_stream(spark, f, of([]).schema) for f, of in zip(folders, (initial_of, changes_of))]
        live.run_live_mart(*streams, stored, state, buckets=buckets)
    values = spark.read.format("statestore").option("stateVarName", "histories").load(state)
    assert values.count() == 7
    got = sorted((tuple(r) for r in stored.mart(spark).collect()), key=str)
    assert got == sorted((tuple(r) for r in license_metrics(initial_of(initial), changes_of(changes)).collect()), key=str)
