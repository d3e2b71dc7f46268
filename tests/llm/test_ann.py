from __future__ import annotations

from collections import defaultdict

import numpy as np

from tallyspan.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>"


def table(spark, vectors, ids=None):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids if ids is not None else range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(ids, vectors, query, k=10):
    away = np.sqrt(((vectors - vectors[query]) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, away)) if i != query][:k]
    return [(int(ids[i]), float(away[i])) for i in order]


def results(df):
    out = {}
    for r in sorted(ann.op2(df).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((6000, 24)).astype(np.float32).astype(float)
    ids = np.arange(6000)
    found = results(table(spark, vectors))
    assert sorted(found) == list(range(0, 6000, 100))
    hits = 0
    for query, rows in found.items():
        want = brute(ids, vectors, query)
        assert len(rows) == 10
        hits += len({v for v, _ in rows} & {v for v, _ in want})
        assert rows == sorted(rows, key=lambda r: (r[1], r[0]))
        for vec_id, score in rows:
            assert abs(score - np.sqrt(((vectors[vec_id] - vectors[query]) ** 2).sum())) < 1e-12
    assert hits >= 0.9 * 10 * len(found)


def test_the_scan_abandons_few_true_neighbours():
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((4000, 64))
    blocks = [vectors[:, c : c + 16].astype(np.float32) for c in range(0, 64, 16)]
    ids = np.arange(4000)
    hits = 0
    for query in range(50):
        want = brute(ids, vectors, query)
        bound = want[-1][1] ** 2 * 1.1
        q = vectors[query]
        at, away = ann.scan(ids, blocks, vectors, query, q.astype(np.float32), q, bound, 10)
        assert list(away) == sorted(away)
        hits += len({v for v, _ in want} & set(at.tolist()))
    assert hits >= 0.97 * 500


def test_many_equal_vectors_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 100)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((1500, 8)).astype(np.float32).astype(float)
    vectors[::3] = vectors[0]
    found = results(table(spark, vectors))
    for query in range(0, 1500, 300):  # ids divisible by 3: copies of the first vector
        copies = [i for i in range(0, 1500, 3) if i != query][:10]
        assert found[query] == [(i, 0.0) for i in copies]


def hits_of(found, ids, vectors):
    """How many of the 10 nearest ids, each at its nearest row, are found; all have the right score."""
    hits = 0
    for query, rows in found.items():
        [own] = np.flatnonzero(ids == query)
        away = np.sqrt(((vectors - vectors[own]) ** 2).sum(axis=1))
        least = {int(i): away[ids == i].min() for i in np.unique(ids) if i != query}
        assert len(rows) == 10
        hits += len({i for i, _ in rows} & set(sorted(least, key=lambda i: (least[i], i))[:10]))
    return hits


def test_a_table_with_its_own_copies(spark):
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal((3000, 12)).astype(np.float32).astype(float)
    df = table(spark, vectors)
    found = results(df.unionAll(df).unionAll(df))
    assert hits_of(found, np.arange(3000), vectors) >= 0.93 * 10 * len(found)
    assert found == results(df)


def test_ids_with_many_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 400)
    rng = np.random.default_rng(9)
    vectors = rng.standard_normal((4000, 8)).astype(np.float32).astype(float)
    ids = np.arange(4000)
    ids[1000:2400] = 7  # a third of the rows
    ids[2401:] = 2401 + (ids[2401:] - 2401) // 20  # 80 ids of 20 rows
    vectors[2401:] = vectors[2401:][np.arange(1599) // 20 * 20] + rng.standard_normal((1599, 8)) * 0.01
    vectors = vectors.astype(np.float32).astype(float)
    queries = [i for i in range(100, 1000, 100)]
    found = {q: r for q, r in results(table(spark, vectors, ids)).items() if q in queries}
    assert sorted(found) == queries
    assert hits_of(found, ids, vectors) >= 0.93 * 10 * len(found)


def test_the_scan_counts_ids():
    rng = np.random.default_rng(2)
    vectors = np.repeat(rng.standard_normal((200, 16)), 12, axis=0)
    ids = np.repeat(np.arange(200), 12)
    q = vectors[0]
    at, away = ann.scan(ids, [vectors.astype(np.float32)], vectors, 0, q.astype(np.float32), q, np.inf, 10)
    want = np.argsort(((vectors[::12] - q) ** 2).sum(axis=1), kind="stable")[1:11]
    assert ids[at].tolist() == want.tolist()


def test_odd_rows_and_few_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (100, [0.0, 2.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None])]
    rows += [(5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 2.0]), (7, [1.0, 2.0, 3.0]), (1, [1.0, 0.5])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", ann.F.lit(1)).withColumn("a.b", ann.F.lit(2))
    found = results(df)
    assert found == {0: [(1, 0.5), (100, np.sqrt(5))], 100: [(1, np.sqrt(2)), (0, np.sqrt(5))]}


def test_no_valid_row(spark):
    assert ann.op2(spark.createDataFrame([], SCHEMA)).collect() == []
    assert ann.op2(spark.createDataFrame([(0, [0.0])], SCHEMA)).collect() == []
    assert ann.op2(spark.createDataFrame([(0, [1.0])], SCHEMA)).collect() == []


def test_a_common_offset_costs_nothing(spark):
    rng = np.random.default_rng(12)
    vectors = 1e4 + 0.1 * rng.standard_normal((1200, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    found = defaultdict(list)
    for r in ann.op2(df).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for q, answers in found.items():
        away = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        away[q] = np.inf
        hits += len({v for v, _ in answers} & set(np.argsort(away, kind="stable")[:10].tolist()))
        assert all(abs(score - away[v]) < 1e-9 for v, score in answers) and len(answers) == 10
    assert hits >= 0.9 * 10 * len(found)


def test_a_query_id_with_several_vectors_is_one_query(spark):
    rng = np.random.default_rng(13)
    vectors = rng.standard_normal((400, 8))
    rows = [(i % 395, v.tolist()) for i, v in enumerate(vectors)]  # ids 0 to 4 have two each
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    own = [v for i, v in rows if i == 0]
    runs = [sorted(map(tuple, ann.op2(df.repartition(n)).where("query_id = 0").collect())) for n in (1, 5)]
    assert runs[0] == runs[1] and len(runs[0]) == 10
    best = [{r[2]: r[3] for r in runs[0]}]
    fits = 0
    for v in own:
        away = {}
        for i, other in rows:
            if i != 0:
                away[i] = min(away.get(i, np.inf), float(np.linalg.norm(np.array(v) - np.array(other))))
        fits += all(abs(away[i] - score) < 1e-9 for i, score in best[0].items())
    assert fits == 1
