"""Hot keys, and plans that must not hold a group or a pair set in one place."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyspan.registry.queries import REGISTRY
from tallyspan.operators import allocation, history, panel, quality, ranking
from tallyspan.operators.skew import hot_safe_join, rows_of_keys
from tallyspan.plans.metrics import license_metrics
from tallyspan.session import scratch_path
from tallyspan.sources import fixtures as fx

SF_DIR = "/root/testdata/sf0.001"
EAGER = ("stream_", "inc_first", "inc_batches", "inc_checkpoint", "inc_backfill", "partition_overwrite", "metric_store")
EAGER += ("inc_metrics", "inc_undated", "inc_rejected", "inc_late", "rows_known", "dq_incremental")


@pytest.mark.parametrize("name", [n for n in REGISTRY if not n.startswith(EAGER)])
def test_no_pair_joins_and_no_python_in_plans(spark, name):
    plan = REGISTRY[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in plan


def test_metrics_read_only_their_columns(spark):
    plan = license_metrics(*fx.sparse(spark, SF_DIR))._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan
    assert "PushedFilters: [IsNotNull(o_orderdate), IsNotNull(o_custkey)]" in plan


def test_dedup_limits_each_key_before_the_shuffle(spark):
    plan = REGISTRY["stg_changes"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_shuffle


@pytest.fixture
def plain_joins(spark):
    """Sort-merge joins, as large tables have."""
    large = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in large}
    for key, value in large.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def hot_changes(spark):
    """Licence 1 has two thirds of the rows; they sit in several input files."""
    rows = spark.range(60_000).selectExpr(
        "id",
        "if(id % 3 < 2, 1L, id) AS license_id",
        "date_add(date'2024-01-01', int(id % 400)) AS date",
        "id % 5000 AS price",
        "'PASS' AS type",
        "id % 2 = 0 AS renewable",
    )
    path = scratch_path(spark, "hot")
    rows.repartition(12).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_hot_safe_join_equals_a_join(spark, plain_joins, how):
    facts = spark.range(5000).selectExpr("id", "if(id % 3 < 2, if(id % 2 = 0, 1, NULL), id) AS k")
    lookup = spark.range(0, 4000, 2).selectExpr("if(id = 0, 1, id) AS k", "id AS v")
    got = hot_safe_join(facts, lookup, ["k"], "id", how, hot_rows=100)
    expected = facts.join(lookup, ["k"], how)
    assert got.columns == expected.columns
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count()


@pytest.mark.parametrize("max_broadcast", [10, 10_000])
def test_rows_of_keys(spark, plain_joins, max_broadcast):
    facts = spark.range(5000).selectExpr("id", "if(id % 3 < 2, 1, id) AS k")
    keys = spark.range(1, 4000, 7).selectExpr("id AS k")
    got = rows_of_keys(facts, keys, "k", "id", max_broadcast)
    assert sorted(map(tuple, got.select("id", "k").collect())) == sorted(
        map(tuple, facts.join(keys, "k", "left_semi").select("id", "k").collect())
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("_salt" in plan) == (max_broadcast == 10)


def test_hot_licence_spreads_over_tasks(spark, plain_joins):
    changes = hot_changes(spark)
    known = quality.entity_keys(fx.entities(changes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    joined = hot_safe_join(changes, known, ["license_id"], "id", hot_rows=1000)
    sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 60_000 and max(sizes) < 15_000


def test_reduction_after_a_licence_join_is_shuffled_again(spark, plain_joins):
    changes = hot_changes(spark)
    touched = changes.select("license_id").distinct()
    kept = hot_safe_join(changes, touched, ["license_id"], "id", "left_semi", hot_rows=1000)
    plan = history.state_log(fx.entities(changes), kept)._jdf.queryExecution().executedPlan().toString()
    above_join = plan.split("LeftSemi")[0]
    assert "hashpartitioning(license_id" in above_join
    assert kept.count() == 60_000


def test_hot_licence_gives_the_same_metrics(spark, plain_joins):
    changes = hot_changes(spark)
    initial = fx.entities(changes)
    by_panel = (
        panel.daily_states(initial, changes)
        .groupBy("date")
        .agg(F.count_if("renewable").alias("a"), F.sum(F.when(F.col("renewable"), F.col("price")).otherwise(0)).alias("p"))
    )
    fast = (
        license_metrics(initial, changes)
        .groupBy("date")
        .agg(F.sum("active_license_count").alias("a"), F.sum("active_license_price").alias("p"))
    )
    assert fast.exceptAll(by_panel).count() == 0 and by_panel.count() == fast.count()


def brute_toggles(rows):
    active: dict[int, bool] = {}
    kind: dict[int, str | None] = {}
    out = {}
    for key, seq, label in sorted(rows, key=lambda r: r[1]):
        if label is not None and label.startswith("RENEW"):
            active[key] = not active.get(key, True)
        elif label is not None:
            kind[key] = label
        out[key, seq] = (kind.get(key), active.get(key, True))
    return out


@pytest.mark.parametrize("width", [1, 7, 100, 10_000])
def test_toggle_segments_equal_a_scan(spark, width):
    rng = random.Random(width)
    rows = [(rng.choice([None, 1, 1, 1, 2]), i, rng.choice(["PASS", "SIM", "RENEW_SIM", "RENEW", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, seq long, label string")
    got = ranking.toggle_states(df, "k", "seq", "label", width=width).collect()
    assert {(r.k, r.seq): (r.main_type, r.is_active) for r in got} == brute_toggles(rows)


def test_batches_follow_the_global_order(spark):
    rows = [(i, (i * 7919) % 13) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, day long").repartition(5)
    got = {r.id: r.batch_id for r in ranking.assign_batches(df, 30, "day", "id", width=7).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    assert got == {r[0]: i // 30 for i, r in enumerate(order)}
    with pytest.raises(ValueError):
        ranking.assign_batches(df, 0, "day", "id")


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_repeat_rows_in_chunks(spark, chunk):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 10), (4, 2500), (5, None)], "k long, n long")
    got = sorted((r.k, r.copy) for r in allocation.repeat_rows(df, "n", chunk).collect())
    assert got == [(k, c) for k, n in ((2, 1), (3, 10), (4, 2500)) for c in range(1, n + 1)]


def test_apportion(spark):
    keys = spark.range(1, 21).withColumnRenamed("id", "k")
    got = {r.k: r.allotted for r in allocation.apportion(keys, "k", 500, 1.5).collect()}
    weights = {k: k**-1.5 for k in range(1, 21)}
    whole = sum(weights.values())
    shares = {k: w / whole * 480 for k, w in weights.items()}
    expected = {k: 1 + int(s) for k, s in shares.items()}
    for k in sorted(shares, key=lambda k: (-(shares[k] % 1), k))[: 500 - sum(expected.values())]:
        expected[k] += 1
    assert got == expected and sum(got.values()) == 500
    assert {r.allotted for r in allocation.apportion(keys, "k", 20).collect()} == {1}
    with pytest.raises(Exception, match="at least the number of keys"):
        allocation.apportion(keys, "k", 19).collect()


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_smallest_cut_equals_a_sort(spark, bins):
    rng = random.Random(bins)
    values = [rng.choice([3, 10**18, rng.randrange(10**20)]) for _ in range(300)]
    df = spark.createDataFrame([(str(v),) for v in values], "v string").selectExpr("cast(v AS decimal(38,0)) AS v")
    for count in (0, 1, 40, 299, 300):
        cut, ties = ranking.smallest_cut(df, "v", count, 0, 10**20 + 1, bins)
        assert sum(v < cut for v in values) + ties == count
        assert ties <= sum(v == cut for v in values)
        assert sorted(values)[:count] == sorted([v for v in values if v < cut] + [cut] * ties)
    with pytest.raises(ValueError):
        ranking.smallest_cut(df, "v", 301, 0, 10**20 + 1, bins)


def test_apportion_stores_and_sorts_nothing(spark, monkeypatch):
    monkeypatch.setattr(ranking, "store_and_reload", lambda *_: pytest.fail("a copy is stored"))
    keys = spark.range(1, 2001).withColumnRenamed("id", "k")
    found = allocation.apportion(keys, "k", 10_000, 0.0)  # equal weights: only ties
    assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()
    got = {r.k: r.allotted for r in found.collect()}
    assert sum(got.values()) == 10_000 and set(got.values()) == {5}
    more = {r.k: r.allotted for r in allocation.apportion(keys, "k", 10_007, 0.0).collect()}
    assert [k for k in sorted(more) if more[k] == 6] == list(range(1, 8))
