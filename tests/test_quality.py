from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyspan.functions.columns import is_accepted_price, is_accepted_type, is_weekday, utc_timestamp
from tallyspan.operators import dedup, profiling, quality

D = date.fromisoformat


def flags(df, order):
    return [r[0] for r in df.orderBy(order).select("ok").collect()]


def test_creation_date_vector(initial_of, changes_of):
    initial = initial_of([(1, 1, "SIM", D("2024-01-01"), 1000, True), (2, 1, "SIM", D("2024-02-05"), 1000, True)])
    changes = changes_of([(1, 1, D("2024-01-10"), 1, "SIM", True), (2, 2, D("2024-02-01"), 1, "SIM", True)])
    got = quality.flag_changes(initial, changes).orderBy("id").collect()
    assert [r.change_not_before_creation for r in got] == [True, False]
    assert [r.is_valid for r in got] == [True, False]


def test_duplicate_id_vector(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (2, 2), (3, 3)], "id long, pos long")
    assert flags(dedup.flag_first_occurrence(df, "id", "pos", "ok"), "pos") == [True, True, False, True]


def test_null_ids_are_duplicates_of_each_other(spark):
    df = spark.createDataFrame([(None, 0), (None, 1), (4, 2)], "id long, pos long")
    assert flags(dedup.flag_first_occurrence(df, "id", "pos", "ok"), "pos") == [True, False, True]


def test_id_exists_vector(spark):
    known = spark.createDataFrame([(1,), (3,), (5,)], "license_id long")
    ids = spark.createDataFrame([(i,) for i in range(1, 5)], "id long")
    missing = {r.license_id for r in quality.unchanged_entities(ids, known).collect()}
    assert [i not in missing for i in range(1, 5)] == [True, False, True, False]


def test_type_and_price_vectors(spark):
    kinds = spark.createDataFrame(enumerate(["PASS", "SIM", "INVALID", "SUPERVISION", None]), "n long, type string")
    assert flags(kinds.withColumn("ok", is_accepted_type(F.col("type"))), "n") == [True, True, False, True, False]
    prices = spark.createDataFrame(enumerate([-10, 0, 2500, 5000, 6000, None]), "n long, price long")
    got = flags(prices.withColumn("ok", is_accepted_price(F.col("price"))), "n")
    assert got == [False, True, True, True, False, False]


def report(df):
    return {(r.rule, r.table_name): (r.checked, r.failed) for r in df.collect()}


def test_quality_report_counts_nulls_orphans_and_copies(initial_of, changes_of):
    initial = initial_of(
        [
            (1, 1, "SIM", D("2024-01-02"), 1000, True),
            (1, 1, "SIM", D("2024-01-09"), 1000, True),  # copy of an id
            (2, 1, "ODD", D("2024-01-01"), 9000, True),  # never changed
            (None, 1, "SIM", D("2024-01-01"), 10, True),
            (None, 1, "SIM", D("2024-01-01"), 10, True),
            (3, 1, "SIM", None, 10, True),  # no creation date
        ]
    )
    changes = changes_of(
        [
            (1, 1, D("2024-01-01"), 10, "SIM", True),  # early
            (2, 1, D("2024-01-03"), 10, None, True),
            (3, 7, D("2024-01-03"), -1, "SIM", True),  # orphan
            (4, None, D("2024-01-03"), 10, "SIM", True),
            (5, 3, D("2024-01-03"), 10, "SIM", True),  # creation date unknown
            (6, 1, None, 10, "SIM", True),
        ]
    )
    assert report(quality.quality_report(initial, changes)) == {
        ("change_type_accepted", quality.CHANGES): (6, 1),
        ("change_price_in_range", quality.CHANGES): (6, 1),
        ("change_not_before_creation", quality.CHANGES): (6, 5),
        ("change_has_entity", quality.CHANGES): (6, 2),
        ("entity_type_accepted", quality.ENTITIES): (6, 1),
        ("entity_price_in_range", quality.ENTITIES): (6, 1),
        ("entity_has_change", quality.ENTITIES): (6, 3),
        ("entity_id_unique", quality.ENTITIES): (6, 2),
    }
    flagged = quality.flag_changes(initial, changes)
    assert flagged.where("NOT change_not_before_creation").count() == 5
    assert flagged.where("NOT change_has_entity").count() == 2


def test_reports_on_empty_tables(initial_of, changes_of):
    empty = quality.quality_report(initial_of([]), changes_of([]))
    assert {(r.checked, r.failed, r.failed_ratio) for r in empty.collect()} == {(0, 0, 0.0)}


def test_consistency_report_finds_each_fault(initial_of, changes_of):
    initial = initial_of([(1, 0, "SIM", D("2024-01-02"), 100, None), (1, 2, "ODD", D("2025-01-02"), 0, True)])
    changes = changes_of([(None, 1, D("2024-01-02"), 1000, "SIM", True), (None, -1, None, 100, "PASS", False)])
    got = report(quality.consistency_report(initial, changes, D("2024-06-01")))
    failed = {rule: bad for (rule, _), (_, bad) in got.items()}
    assert failed == {
        "entity_no_missing_values": 1,
        "entity_price_positive": 1,
        "entity_price_matches_type": 2,
        "entity_not_in_future": 1,
        "entity_customer_id_positive": 1,
        "entity_renewable_is_boolean": 1,
        "entity_type_accepted": 1,
        "entity_id_unique": 1,
        "change_no_missing_values": 2,
        "change_price_positive": 0,
        "change_price_matches_type": 0,
        "change_not_in_future": 1,
        "change_license_id_positive": 1,
        "change_renewable_is_boolean": 0,
        "change_id_unique": 1,
    }


def test_transition_shares_sum_to_one(spark):
    states = spark.createDataFrame(
        [(1, D("2024-01-01"), "A"), (1, D("2024-01-02"), "B"), (1, D("2024-01-03"), "A"), (1, D("2024-01-04"), "A"), (2, D("2024-01-01"), "A"), (2, D("2024-01-02"), "B")],
        "license_id long, date date, type string",
    )
    rows = profiling.type_transitions(states).collect()
    by_type: dict[str, float] = {}
    for r in rows:
        by_type[r.from_type] = by_type.get(r.from_type, 0) + r.transition_share
    assert all(abs(total - 1) < 1e-5 for total in by_type.values()) and set(by_type) == {"A", "B"}


def test_weekday_is_monday_to_friday(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-07')) AS d")  # a Monday first
    assert [r[0] for r in days.orderBy("d").select(is_weekday(F.col("d"))).collect()] == [True] * 5 + [False] * 2


def test_utc_timestamp_rejects_offsets(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00",), ("2024-01-01T10:00:00+02:00",), ("2024-01-01T10:00:00Z",), ("x",)], "t string")
    got = [r[0] for r in df.select(F.unix_timestamp(utc_timestamp(F.col("t")))).collect()]
    assert got == [1704103200, None, None, None]


def test_distribution_checks(spark, initial_of):
    rows = [(i, i % 10, "SIM", D("2024-01-01"), 1000, i != 7) for i in range(300)]
    exact = quality.distribution_checks(initial_of(rows)).first()
    assert tuple(exact) == (10, 300, False, True)
    rough = quality.distribution_checks(initial_of(rows), approximate=True).first()
    assert abs(rough.n_licenses - 300) < 30 and rough.n_customers == 10 and rough.fewer_customers


def test_shares_in_the_long_run(spark):
    from tallyspan.operators.profiling import steady_state

    # A and B swap for ever, C goes to D or stays, D has no way out.
    moves = [("A", "B", 5), ("B", "A", 2), ("C", "C", 3), ("C", "D", 1)]
    found = steady_state(spark.createDataFrame(moves, "from_type string, to_type string, n_transitions long")).collect()
    got = {(r.from_type, r.to_type): round(r.share, 6) for r in found if r.share > 1e-7}
    assert got == {("A", "A"): 0.5, ("A", "B"): 0.5, ("B", "A"): 0.5, ("B", "B"): 0.5, ("C", "D"): 1.0, ("D", "D"): 1.0}


def test_sketches_merge_over_any_days(spark):
    from tallyspan.operators import quality

    rows = spark.range(60_000).selectExpr(
        "date_add(date'2024-01-01', int(id % 30)) AS day", "id % 20011 AS a", "if(id % 5 = 0, NULL, 'x') AS b"
    )
    sketches = quality.daily_sketches(rows, "day", ["a", "b"])
    windows = spark.sql("SELECT * FROM VALUES (date'2024-01-01', date'2024-01-30'), (date'2024-01-07', date'2024-01-09'), (date'2025-01-01', date'2025-01-02') AS w(first_day, last_day)")
    got = {str(r.first_day): (r.a, r.b) for r in quality.distinct_in_windows(sketches, windows, "day", ["a", "b"]).collect()}
    for first, last in (("2024-01-01", "2024-01-30"), ("2024-01-07", "2024-01-09")):
        exact = rows.where(f"day BETWEEN '{first}' AND '{last}'").select("a").distinct().count()
        assert abs(got[first][0] - exact) <= 0.06 * exact and got[first][1] == 1
    assert got["2025-01-01"] == (0, 0)
