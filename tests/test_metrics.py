from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.operators import history, metrics, panel, spine
from tallyspan.plans.metrics import daily_events, license_metrics, register_views
from tests import naive

D = date.fromisoformat
PANEL = T.StructType(
    [
        T.StructField("license_id", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("type", T.StringType()),
        T.StructField("renewable", T.BooleanType()),
        T.StructField("price", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)


def bounds_of(spark, first, last):
    schema = T.StructType([T.StructField("first_day", T.DateType()), T.StructField("last_day", T.DateType())])
    return spark.createDataFrame([(D(first), D(last))], schema)


def random_tables(seed, gaps):
    """Few licences over few days: many same-day repeats, pre-creation changes, orphans,
    repeated entity ids and, with ``gaps``, NULL attributes."""
    rng = random.Random(seed)
    day = lambda: D("2024-01-01") + timedelta(days=rng.randrange(25))
    kind = lambda: rng.choice(["PASS", "SIM", "SUPERVISION"])
    maybe = lambda v: None if gaps and rng.random() < 0.25 else v
    initial = [(i, i % 3, kind(), day(), rng.randrange(1, 50), True) for i in range(1, 8)]
    taken = {(r[0], r[3]) for r in initial}
    for i in (2, 5):
        again = (i, i % 3, kind(), day(), 7, True)
        if (i, again[3]) not in taken:
            initial.append(again)
    changes = [
        (n, rng.randrange(1, 10), day(), maybe(rng.randrange(1, 50)), maybe(kind()), maybe(rng.random() < 0.6))
        for n in range(rng.randrange(1, 90))
    ]
    return initial, changes


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("fill", ["row", "column"])
@pytest.mark.parametrize("seed", range(6))
def test_mart_equals_naive_grid(spark, initial_of, changes_of, seed, fill):
    initial, changes = random_tables(seed, gaps=seed % 2 == 1)
    got = license_metrics(initial_of(initial), changes_of(changes), fill)
    assert rows_of(got) == sorted(naive.mart(initial, changes, fill), key=str)


@pytest.mark.parametrize("seed", [1, 3])
def test_panel_equals_naive_grid(spark, initial_of, changes_of, seed):
    initial, changes = random_tables(seed, gaps=True)
    for fill in ("row", "column"):
        got = panel.daily_states(initial_of(initial), changes_of(changes), fill)
        expected = [(lic, day, r, k, p) for (lic, day), (r, p, k) in naive.panel(initial, changes, fill).items()]
        assert rows_of(got) == sorted(expected, key=str)


def test_input_order_does_not_matter(spark, initial_of, changes_of):
    initial, changes = random_tables(11, gaps=True)
    changes += [(c[0], c[1], c[2], 9999, "PASS", False) for c in changes[::4]]  # repeated change ids
    first = rows_of(history.state_history(initial_of(initial), changes_of(changes)))
    rng = random.Random(5)
    for _ in range(2):
        rng.shuffle(initial)
        rng.shuffle(changes)
        again = history.state_history(initial_of(initial), changes_of(changes).repartition(3))
        assert rows_of(again) == first


def test_change_wins_over_entity_row_even_with_a_low_id(initial_of, changes_of):
    day = D("2024-01-01")
    got = history.state_history(
        initial_of([(1, 1, "PASS", day, 100, True)]), changes_of([(-9, 1, day, 5000, "SUPERVISION", False)])
    )
    assert [(r.id, r.type, r.renewable) for r in got.collect()] == [(-9, "SUPERVISION", False)]


def test_orphans_and_early_changes_only_move_the_calendar(initial_of, changes_of):
    initial = initial_of([(1, 1, "PASS", D("2024-01-05"), 100, True)])
    changes = changes_of(
        [
            (1, 1, D("2024-01-03"), 1000, "SIM", True),  # before creation
            (2, 99, D("2024-01-08"), 1000, "SIM", True),  # no such licence
        ]
    )
    rows = license_metrics(initial, changes).orderBy("date").collect()
    assert [r.date for r in rows] == [D("2024-01-03") + timedelta(days=i) for i in range(6)]
    assert {r.type for r in rows} == {"PASS"}
    assert [r.active_license_count for r in rows] == [0, 0, 1, 1, 1, 1]
    assert [r.daily_active_diff for r in rows] == [0, 0, 1, 0, 0, 0]


def test_decimal_prices(initial_of, changes_of):
    money = F.col("price").cast("decimal(18,2)") / 4
    initial = initial_of([(1, 1, "PASS", D("2024-01-05"), 101, True)]).withColumn("price", money)
    changes = changes_of([(1, 1, D("2024-01-06"), 7, "PASS", True)]).withColumn("price", money)
    rows = license_metrics(initial, changes).orderBy("date").collect()
    assert [(float(r.active_license_price), float(r.daily_price_diff)) for r in rows] == [(25.25, 0), (1.75, -23.5)]


def test_empty_inputs(initial_of, changes_of):
    assert license_metrics(initial_of([]), changes_of([])).collect() == []


def test_panel_price_vector(spark):
    rows = [
        (1, D("2024-01-01"), "A", True, 10, 0),
        (2, D("2024-01-01"), "A", False, 20, 0),
        (1, D("2024-01-02"), "A", True, 30, 0),
    ]
    got = metrics.panel_price(spark.createDataFrame(rows, PANEL), bounds_of(spark, "2024-01-01", "2024-01-02"))
    assert rows_of(got) == [(D("2024-01-01"), "A", 10), (D("2024-01-02"), "A", 30)]


def test_last_row_of_a_licence_day_counts(spark):
    rows = [
        (1, D("2023-01-08"), "PASS", True, 100, 0),
        (1, D("2023-01-09"), "PASS", True, 100, 1),
        (1, D("2023-01-09"), "PASS", False, 100, 2),
    ]
    bounds = bounds_of(spark, "2023-01-08", "2023-01-09")
    got = metrics.panel_counts(spark.createDataFrame(rows, PANEL), bounds, [F.col("seq").desc()])
    cells = [(r.active_license_count, r.inactive_license_count, r.daily_active_diff) for r in got.orderBy("date").collect()]
    assert cells == [(1, 0, 0), (0, 1, -1)]


def test_daily_events_vector(spark):
    schema = "date date, type string, activated long, deactivated long"
    states = spark.createDataFrame([(D("2024-01-01"), "ABC", 1, 0)], schema)
    got = metrics.daily_events(states, bounds_of(spark, "2024-01-01", "2024-01-02"))
    assert rows_of(got) == [(D("2024-01-01"), "ABC", 1, 0), (D("2024-01-02"), "ABC", 0, 0)]


def test_daily_events_of_two_entities(initial_of, changes_of):
    initial = initial_of([(1, 1, "A", D("2024-01-01"), 10, True), (2, 1, "A", D("2024-01-02"), 20, True)])
    changes = changes_of([(100, 1, D("2024-01-03"), 10, "A", False)])
    got = rows_of(daily_events(initial, changes))
    assert got == [(D("2024-01-01"), "A", 1, 0), (D("2024-01-02"), "A", 1, 0), (D("2024-01-03"), "A", 0, 1)]


def test_densify_keeps_keys_and_drops_days_outside(spark):
    rows = [
        (D("2024-01-02"), "in", 5),
        (D("2024-01-05"), "in", None),
        (D("2023-12-01"), "in", 7),
        (D("2024-03-01"), "out", 8),
        (D("2024-03-02"), "out", 9),
        (D("2024-01-03"), None, 4),
    ]
    df = spark.createDataFrame(rows, "date date, k string, n long")
    got = spine.densify(df, ["k"], bounds_of(spark, "2024-01-01", "2024-01-04"), {"n": 0})
    days = [D("2024-01-01") + timedelta(days=i) for i in range(4)]
    expected = [(d, k, 5 if (d, k) == (days[1], "in") else 0) for d in days for k in ("in", "out", None)]
    assert rows_of(got) == sorted(expected, key=str)


def test_asof_lookup_vector(spark):
    states = spark.createDataFrame(
        [(1, D("2024-01-01"), True, 10, "A"), (1, D("2024-01-05"), False, 20, "B"), (2, D("2024-01-03"), True, 30, "A")],
        "license_id long, date date, renewable boolean, price long, type string",
    )
    points = spark.createDataFrame(
        [(1, D("2023-12-31"), "a"), (1, D("2024-01-05"), "b"), (1, D("2024-01-04"), "c"), (1, D("2024-01-04"), "d"), (3, D("2024-01-04"), "e")],
        "license_id long, date date, point string",
    )
    got = {r.point: (r.state_date, r.type) for r in panel.asof_lookup(points, states, "point").collect()}
    assert got == {
        "a": (None, None),
        "b": (D("2024-01-05"), "B"),
        "c": (D("2024-01-01"), "A"),
        "d": (D("2024-01-01"), "A"),
        "e": (None, None),
    }


def test_views(spark, initial_of, changes_of):
    initial, changes = random_tables(2, gaps=False)
    names = register_views(spark, initial_of(initial), changes_of(changes))
    total = spark.sql("SELECT count(*) FROM mart_license_metrics").first()[0]
    days = spark.sql("SELECT count(*) FROM inter_licenses_calendar").first()[0]
    assert total == 3 * days and len(names) == 7
