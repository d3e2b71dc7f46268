"""Times, CSV files, exact shares and generic rules."""

from __future__ import annotations

import os
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyspan.functions.columns import utc_timestamp
from tallyspan.operators import allocation, profiling, quality, ranking, upsert
from tallyspan.plans.metrics import license_metrics
from tallyspan.schemas import CHANGES_SCHEMA
from tallyspan.sources import files

D = date.fromisoformat


@pytest.fixture
def auckland():
    before = os.environ.get("TZ")
    os.environ["TZ"] = "Pacific/Auckland"
    time.tzset()
    yield
    if before is None:
        del os.environ["TZ"]
    else:
        os.environ["TZ"] = before
    time.tzset()


def test_window_bounds_are_utc_wherever_the_driver_is(spark, auckland):
    rows = spark.sql("SELECT timestamp_seconds(3600 * id) AS t, id FROM range(0, 48)")
    got = upsert.select_window(rows, "t", datetime(1970, 1, 1, 1), datetime(1970, 1, 1, 23))
    assert sorted(r.id for r in got.collect()) == list(range(1, 24))


@pytest.mark.parametrize(
    "text,seconds",
    [
        ("1970-01-02", 86400),
        ("1970-01-02 00:00:01", 86401),
        ("1970-01-02T00:01", 86460),
        ("1970-01-02T00:00:00.5", 86400.5),
        *[(f"1970-01-02 10:00:00{x}", None) for x in ("Z", "+02", "+2:00", " UTC+2", " Europe/Paris", "+02:00 ", " ")],
        ("10:00:00", None),
        ("1970-01", None),
        ("1970-13-01", None),
        (" 1970-01-02", None),
        ("", None),
        (None, None),
    ],
)
def test_only_full_iso_text_is_a_time(spark, text, seconds):
    df = spark.createDataFrame([(text,)], "t string")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            [row] = df.select(F.unix_micros(utc_timestamp(F.col("t"))).alias("m")).collect()
            assert row.m == (None if seconds is None else seconds * 1_000_000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "c.csv").write_text("price,id,extra,license_id,date,type,renewable\n5,1,x,2,2024-01-02,SIM,true\n")
    [row] = files.read_csv(spark, str(tmp_path), CHANGES_SCHEMA).collect()
    assert tuple(row) == (1, 2, D("2024-01-02"), 5, "SIM", True)
    (tmp_path / "d.csv").write_text("id,price,extra,license_id,date,type,renewable\n1,5,x,2,2024-01-02,SIM,true\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path), CHANGES_SCHEMA).collect()


def test_csv_without_a_column_or_with_a_bad_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,license_id\n1,2\n")
    with pytest.raises(ValueError, match="no column date"):
        files.read_csv(spark, str(tmp_path / "a.csv"), CHANGES_SCHEMA)
    (tmp_path / "b.csv").write_text("id,license_id,date,price,type,renewable\n1,2,2024-01-02,abc,SIM,true\n")
    with pytest.raises(Exception, match="(?i)malformed|failfast|parse"):
        files.read_csv(spark, str(tmp_path / "b.csv"), CHANGES_SCHEMA).select("id").collect()


def test_shares_do_not_depend_on_the_layout(spark):
    keys = spark.range(1, 30_001).withColumnRenamed("id", "k")
    layouts = [keys.repartition(3), keys.orderBy(F.col("k").desc()).repartition(7, "k")]
    got = [{r.k: r.allotted for r in allocation.apportion(k, "k", 10**13).collect()} for k in layouts]
    assert got[0] == got[1]
    assert sum(got[0].values()) == 10**13


def test_batches_leave_nothing_behind(spark, monkeypatch):
    from tallyspan import session

    monkeypatch.setattr(session, "store_and_reload", lambda *_: pytest.fail("a copy is stored"))
    monkeypatch.setattr(ranking, "store_and_reload", lambda *_: pytest.fail("a copy is stored"))
    rows = [(i, None if i % 7 == 0 else i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, day long").repartition(3)
    got = {r.id: r.batch_id for r in ranking.assign_batches(df, 11, "day", "id", width=20).collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert got == {r[0]: i // 11 for i, r in enumerate(order)}


def test_rows_of_one_chunk_are_not_shuffled(spark):
    df = spark.createDataFrame([(1, 2)], "k long, n long").where("n < 100000")
    plan = allocation.repeat_rows(df, "n")
    small = plan.where("copy < 0")._jdf.queryExecution().optimizedPlan().toString()
    assert small.count("RepartitionByExpression") == 1


def test_generic_rules(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, None)], "id long, kind string")
    b = spark.createDataFrame([(1,), (1,), (5,)], "ref long")
    got = quality.accepted_values_report({"a": (a, {"kind": ["x"], "id": [1, 2]})}).collect()
    assert {(r.rule, r.checked, r.failed) for r in got} == {("kind_accepted", 3, 2), ("id_accepted", 3, 1)}
    got = quality.relationships_report([("b", b, "ref", "a", a, "id"), ("a", a, "id", "b", b, "ref")]).collect()
    assert {(r.rule, r.table_name, r.checked, r.failed) for r in got} == {("ref_in_a", "b", 3, 1), ("id_in_b", "a", 3, 1)}


def test_invariants_see_a_wrong_metric(initial_of, changes_of):
    initial = initial_of([(1, 1, "PASS", D("2024-01-02"), 100, True)])
    changes = changes_of([(1, 1, D("2024-01-04"), 100, "PASS", False)])
    mart = license_metrics(initial, changes)
    verdicts = {r.invariant: r.holds for r in quality.mart_invariants(mart, initial, changes).collect()}
    assert verdicts == {"columns": True, "non_negative": True, "list_price": True, "last_day_total": True}
    wrong = mart.withColumn("inactive_license_count", F.lit(-1).cast("long")).withColumn("extra", F.lit(1))
    verdicts = {r.invariant: r.holds for r in quality.mart_invariants(wrong, initial, changes).collect()}
    assert verdicts == {"columns": False, "non_negative": False, "list_price": True, "last_day_total": False}


def test_shares_of_a_row_sum_to_one(spark):
    rows = [("A", "B", 1), ("A", "C", 1), ("A", "D", 1), ("B", "A", 5)]
    shares = spark.createDataFrame(rows, "from_type string, to_type string, n long").selectExpr(
        "from_type", "to_type", "round(n / sum(n) OVER (PARTITION BY from_type), 6) AS transition_share"
    )
    assert all(r.sums_to_one for r in profiling.transition_row_sums(shares).collect())
    half = shares.where("to_type <> 'D'")
    assert {r.from_type: r.sums_to_one for r in profiling.transition_row_sums(half).collect()} == {"A": False, "B": True}


def test_scratch_tables_can_be_cleared(spark, tmp_path):
    from tallyspan import session

    kept, session._made[:] = list(session._made), []
    path = session.scratch_path(spark, "clear")
    spark.range(3).write.parquet(path)
    assert files.path_exists(spark, path)
    session.clear_scratch(spark)
    assert not files.path_exists(spark, path)
    session._made[:] = kept
