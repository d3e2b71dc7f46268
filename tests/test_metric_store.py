from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.plans.metric_store import MetricStore
from tallyspan.plans.metrics import license_metrics
from tallyspan.session import scratch_path
from tallyspan.sources.pointer import Pointer
from tests.test_metrics import random_tables

D = date.fromisoformat


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [21, 23])
def test_build_and_corrections_equal_one_computation(spark, initial_of, changes_of, seed):
    initial, changes = random_tables(seed, gaps=True)
    first, second, third = (changes_of(changes[i::3]) for i in range(3))
    early, late_entities = initial_of(initial[:5]), initial_of(initial[5:])
    store = MetricStore(scratch_path(spark, "metrics"))

    store.build(spark, early, first)
    assert rows_of(store.mart(spark)) == rows_of(license_metrics(early, first))

    store.correct(1, early, first, second, late_entities)
    both = initial_of(initial)
    assert rows_of(store.mart(spark)) == rows_of(license_metrics(both, first.unionByName(second)))

    for _ in range(2):  # running a correction again changes nothing
        store.correct(2, both, first.unionByName(second), third)
        assert rows_of(store.mart(spark)) == rows_of(license_metrics(both, changes_of(changes)))


def test_bounds_come_from_all_rows(spark, initial_of, changes_of):
    initial = initial_of([(1, 1, "PASS", D("2024-01-05"), 100, True)])
    changes = changes_of([(1, 99, D("2024-01-01"), 1, "SIM", True), (2, None, D("2024-01-09"), 1, "SIM", True)])
    store = MetricStore(scratch_path(spark, "metrics"))
    store.build(spark, initial, changes)
    assert tuple(store.bounds(spark).first()) == (D("2024-01-01"), D("2024-01-09"))
    assert rows_of(store.mart(spark)) == rows_of(license_metrics(initial, changes))
    with pytest.raises(ValueError):
        store.build(spark, initial, changes)


@pytest.mark.parametrize("again", [False, True])
def test_a_run_that_stops_does_not_count(spark, initial_of, changes_of, monkeypatch, again):
    """Also where the run has been there before: the first attempt stays whole."""
    initial = initial_of([(1, 1, "PASS", D("2024-01-05"), 100, True)])
    known = changes_of([(1, 1, D("2024-01-07"), 1000, "SIM", True)])
    late = changes_of([(2, 1, D("2024-01-06"), 5000, "SUPERVISION", True)])
    store = MetricStore(scratch_path(spark, "metrics"))
    store.build(spark, initial, known)
    if again:
        store.correct(1, initial, known, late)
    before = rows_of(store.mart(spark))
    with monkeypatch.context() as patch:
        patch.setattr(Pointer, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            store.correct(1, initial, known, late)
    assert rows_of(store.mart(spark)) == before
    store.correct(1, initial, known, late)
    assert rows_of(store.mart(spark)) == rows_of(license_metrics(initial, known.unionByName(late)))


def test_decimal_prices(spark, initial_of, changes_of):
    money = F.col("price").cast("decimal(18,2)") / 4
    initial = initial_of([(1, 1, "PASS", D("2024-01-05"), 101, True)]).withColumn("price", money)
    changes = changes_of([(1, 1, D("2024-01-06"), 7, "PASS", True)]).withColumn("price", money)
    store = MetricStore(scratch_path(spark, "metrics"), T.DecimalType(38, 4))
    store.build(spark, initial, changes)
    rows = store.mart(spark).orderBy("date").collect()
    assert [float(r.active_license_price) for r in rows] == [25.25, 1.75]


def test_empty_inputs(spark, initial_of, changes_of):
    store = MetricStore(scratch_path(spark, "metrics"))
    store.build(spark, initial_of([]), changes_of([]))
    assert store.mart(spark).collect() == []
