from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from tallyspan.llm import sharding
from tests.llm import data


def check(df, found):
    want = Counter()
    for r in df.collect():
        text = (r.text or "").encode()
        want[r.doc_id, len(text) + 1, zlib.crc32(text)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    slots, shards = defaultdict(list), defaultdict(set)
    for r in found:
        assert (r.law, r.grown_shard) == ("bytes", None)
        slots[r.shard].append(r.slot)
        shards[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())
    return [sum(r.size for r in found if r.shard == s) for s in range(8)]


def test_equal_texts_stay_together_and_bytes_are_even(spark):
    df = data.messy(spark)
    rows = [r for r in df.collect() if len(r.text or "") < 1000]
    df = spark.createDataFrame(rows, data.DOCUMENTS)
    loads = check(df, sharding.op10(df).collect())
    largest = max(Counter((r.text or "") for r in rows).items(), key=lambda x: x[1] * len(x[0]))
    assert max(loads) - min(loads) <= max(50, largest[1] * len(largest[0]))


def test_one_large_group_is_offset_by_the_rest(spark):
    rows = [(i, "x" * 999, None, None, None) for i in range(300)]
    rows += [(1000 + i, f"{i:06d}" * (20 + i % 7), None, None, None) for i in range(3000)]
    df = spark.createDataFrame(rows, data.DOCUMENTS)
    loads = check(df, sharding.op10(df).collect())
    others = sorted(loads)[:-1]
    assert max(others) - min(others) < 0.001 * sum(loads)


def test_equal_rows_are_numbered_in_many_buckets(spark):
    placed = spark.range(6400).selectExpr("7L AS key", "9L AS size", "5L AS text_crc32", "0 AS shard")
    sizes = [r["count"] for r in sharding._bucketed(placed).groupBy("_bucket").count().collect()]
    assert max(sizes) < 200
    found = sharding.with_slots(placed)
    assert found.columns.count("slot") == 1 and set(found.columns) == {"key", "size", "text_crc32", "shard", "slot"}
    assert sorted(r.slot for r in found.collect()) == list(range(6400))


def test_messy_clashing_and_empty(spark):
    df = data.clashing(spark, ["key", "size", "shard", "a.b"])
    check(df, sharding.op10(df).collect())
    assert sharding.op10(data.empty(spark)).collect() == []
