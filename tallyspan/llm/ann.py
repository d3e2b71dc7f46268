"""Approximate nearest neighbours by Euclidean distance: inverted lists with an adaptive
dimension scan.

Index: k-means centres (fitted on a bounded sample) divide all vectors into lists; a random
rotation, the same for all, spreads every vector's length evenly over its components, and the rotated
vectors are kept in blocks of columns.  Search: a query probes its nearest lists.  Inside a list
the squared distances to all its vectors grow block by block; after d of D components a
vector is abandoned if its partial distance is so large that its whole distance is below the current
bound only with a small probability: partial * D / d > bound * (1 + EPSILON / sqrt(d))^2.
Vectors that are left after the last block get their distance in double precision from the
original components.  The first bound of a query is its distance to the k-th of a few
vectors of the sample, then what the list itself yields.

How many lists are probed is measured when the index is fitted: the fewest with which the
queries of the sample find ``RECALL`` of their true neighbours in the sample.

A task holds one block of at most about ``BLOCK_VECTORS`` vectors of a list and one block
of about ``BLOCK_QUERIES`` queries that probe it.  Vectors are cut by a hash of id and vector, queries
by one of the id, so a hot list, a third of equal vectors or a third of rows of one id is many tasks.  Driver and broadcasts hold the sample and
the centres, both bounded.

Defined cases: vectors that are null, zero, of another length than most, or hold a null or a
component that is not finite take no part, nor do rows without an id.  Rows that share an
id are one candidate, at its nearest vector, and one query, by the vector of the smallest hash; rows that repeat id
and vector are dropped first.  Fewer than k candidates are all returned: the lists probed hold at
least k + 1 ids if the table does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import begin, pick
from tallyspan.session import store_and_reload

NEIGHBOURS = 10
SAMPLE = 20_000
TRIAL_QUERIES = 256
ANCHORS = 1024
ROWS_PER_LIST = 512
MOST_LISTS = 1024
ROUNDS = 8
RECALL = 0.96
COLUMNS = 16
EPSILON = 2.1
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 512


@dataclass
class Index:
    """What driver and tasks share: bounded by the sample."""

    mean: np.ndarray  # of the sample; centres and rotated vectors are relative to it
    rotation: np.ndarray
    centres: np.ndarray
    probes: int
    anchors: np.ndarray
    anchor_ids: np.ndarray
    anchor_lists: np.ndarray


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """[row of a, row of b]: squared distances."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T, 0)


def valid_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part; ``v`` is an array of doubles."""
    rows = pick(df, id=key, v=vector).select("id", F.col("v").cast("array<double>").alias("v")).where(
        "id IS NOT NULL AND v IS NOT NULL"
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0.0))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (lengths["n"] if lengths else 0))


def fit(rows: DataFrame, seed: int = 11) -> Index | None:
    """An index fitted on the ``SAMPLE`` rows with the smallest hashes."""
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).toArrow()
    if not len(sample):
        return None
    ids = sample["id"].to_numpy()
    vectors = sample["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((vectors.shape[1],) * 2))[0]
    originals, mean = vectors, vectors.mean(axis=0)
    vectors = originals - mean  # what all have in common would cost digits of every distance
    # Equal centres would divide equal vectors at random.
    distinct = np.unique(vectors, axis=0)
    lists = max(1, min(MOST_LISTS, total // ROWS_PER_LIST, len(distinct)))
    centres = distinct[rng.choice(len(distinct), lists, replace=False)]
    for _ in range(ROUNDS):
        at = squared(vectors, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, vectors)
        n = np.bincount(at, minlength=lists)
        centres = np.unique(np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres), axis=0)
        lists = len(centres)
    at = squared(vectors, centres).argmin(axis=1)
    # The rank, among the lists of a trial query, of the list of each true neighbour.
    trial = np.arange(min(TRIAL_QUERIES, len(ids)))
    away = squared(vectors[trial], vectors)
    away[ids[trial][:, None] == ids] = np.inf
    near = np.argsort(away, axis=1, kind="stable")[:, : max(1, min(NEIGHBOURS, len(ids) - 1))]
    order = np.argsort(squared(vectors[trial], centres), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(lists)[None, :].repeat(len(trial), 0), axis=1)
    needed = np.sort(np.take_along_axis(rank, at[near], axis=1).ravel())
    probes = 1 + int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))) - 1)])
    # Anchors of different ids: the k-th nearest of them bounds the k-th nearest id.
    anchor = np.sort(np.unique(ids, return_index=True)[1])[:ANCHORS]
    return Index(mean, rotation, centres, probes, originals[anchor], ids[anchor], at[anchor])


def assign(rows: DataFrame, index: Index) -> DataFrame:
    """(id, list, rotated, v): every row in its list; vectors as bytes."""
    sent = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("ann")
        at = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            rotated = ((v - at.mean) @ at.rotation).astype(np.float32)
            lists = squared(v - at.mean, at.centres).argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lists, pa.int32()),
                    pa.array([r.tobytes() for r in rotated], pa.binary()),
                    pa.array([r.tobytes() for r in v], pa.binary()),
                ],
                names=["id", "list", "rotated", "v"],
            )

    return rows.mapInArrow(run, "id bigint, list int, rotated binary, v binary")


def _plan(batch: pd.DataFrame, index: Index, sizes: np.ndarray, k: int):
    """Per query: its lists, how many of them are probed, and the positions and squared
    distances of the anchors in these lists, nearest first (infinite: not one of them).
    ``sizes`` counts ids, each in one list only, so lists together hold at least their sum."""
    v = np.frombuffer(b"".join(batch["v"]), np.float64).reshape(len(batch), -1)
    order = np.argsort(squared(v - index.mean, index.centres), axis=1, kind="stable")
    held = np.cumsum(sizes[order], axis=1)
    enough = (held < k + 1).sum(axis=1) + 1  # lists until the query and k others are held
    counts = np.minimum(np.maximum(index.probes, enough), order.shape[1])
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), axis=1)
    away = squared(v - index.mean, index.anchors - index.mean)
    away[batch["id"].to_numpy()[:, None] == index.anchor_ids] = np.inf
    away[rank[:, index.anchor_lists] >= counts[:, None]] = np.inf
    near = np.argsort(away, axis=1, kind="stable")[:, :k]
    return v, order, counts, near, np.take_along_axis(away, near, axis=1)


def _probes(queries: DataFrame, index: Index, sizes: np.ndarray, k: int) -> DataFrame:
    """(id, rotated, v, bound, list): a row per query and probed list."""
    sent = queries.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("ann")
        for batch in batches:
            if len(batch):
                _, order, counts, _, away = _plan(batch, sent.value, sizes, k)
                bound = away[:, -1] * (1 + 1e-9) + 1e-9 if away.shape[1] == k else np.inf
                out = batch[["id", "rotated", "v"]].assign(bound=bound)
                out = out.loc[out.index.repeat(counts)]
                out["list"] = np.concatenate([o[:n] for o, n in zip(order, counts)]).astype(np.int32)
                yield out

    return queries.select("id", "rotated", "v").mapInPandas(
        run, "id bigint, rotated binary, v binary, bound double, list int"
    )


def _seeds(queries: DataFrame, index: Index, sizes: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score) of the anchors that gave a query its first bound: the scan
    may abandon one of them by chance, and k ids must be left."""
    sent = queries.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("ann")
        for batch in batches:
            if len(batch):
                v, _, _, near, away = _plan(batch, sent.value, sizes, k)
                query, at = np.nonzero(np.isfinite(away))
                anchor = near[query, at]
                step = sent.value.anchors[anchor] - v[query]
                yield pd.DataFrame(
                    {
                        "query_id": batch["id"].to_numpy()[query],
                        "vec_id": sent.value.anchor_ids[anchor],
                        "score": np.sqrt((step * step).sum(axis=1)),
                    }
                )

    return queries.select("id", "v").mapInPandas(run, "query_id bigint, vec_id bigint, score double")


def scan(
    ids: np.ndarray,
    blocks: list[np.ndarray],
    originals: np.ndarray,
    own: int,
    query: np.ndarray,
    exact: np.ndarray,
    bound: float,
    k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of the nearest ids of one list, each at its nearest row, ``own`` left
    out, by distance and then id.  ``blocks`` hold the rotated vectors' columns, ``bound`` a squared distance
    within which k ids are known to lie."""
    dimensions = len(query)
    alive = np.arange(len(ids))
    partial = np.zeros(len(ids), np.float32)
    seen = 0
    for block in blocks:
        part = query[seen : seen + block.shape[1]]
        step = (block if len(alive) == len(ids) else block[alive]) - part
        partial = partial + np.einsum("ij,ij->i", step, step)
        seen += block.shape[1]
        if seen == dimensions:
            limit = bound * (1 + 1e-4) + 1e-6
        else:
            limit = bound * seen / dimensions * (1 + EPSILON / np.sqrt(seen)) ** 2 + 1e-6
        keep = partial <= limit
        if not keep.all():
            alive, partial = alive[keep], partial[keep]
        if len(alive) == 0:
            break
    other = ids[alive] != own
    alive, partial = alive[other], partial[other]
    if len(alive) > 4 * k:
        # Only what the k-th smallest partial sum (now of all components) of an id leaves possible.
        order = np.argsort(partial, kind="stable")
        least = partial[order[np.unique(ids[alive][order], return_index=True)[1]]]
        if len(least) >= k:
            alive = alive[partial <= np.partition(least, k - 1)[k - 1] * (1 + 1e-4) + 1e-6]
    step = originals[alive] - exact
    away = np.sqrt((step * step).sum(axis=1))
    order = np.lexsort((ids[alive], away))
    order = order[np.sort(np.unique(ids[alive][order], return_index=True)[1])[:k]]
    return alive[order], away[order]


def nearest(
    df: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = NEIGHBOURS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows of ``df`` for each row of
    ``queries`` (id; rows of ``df``), the query's own row apart."""
    spark = df.sparkSession
    none = "query_id bigint, rank int, vec_id bigint, score double"
    rows = valid_vectors(df, key, vector).select(F.col("id").cast("bigint").alias("id"), "v")
    rows = store_and_reload(rows.dropDuplicates(["id", "v"]), "distinct")
    index = fit(rows)
    if index is None:
        return spark.createDataFrame([], none)
    stored = store_and_reload(assign(rows, index), "vectors")

    def counts_of(lists: DataFrame) -> np.ndarray:
        counts = np.zeros(len(index.centres), np.int64)
        for row in lists.groupBy("list").count().collect():
            counts[row["list"]] = row["count"]
        return counts

    held = counts_of(stored)
    sizes = counts_of(stored.groupBy("id").agg(F.min("list").alias("list")))
    wanted = stored.join(queries.select(F.col("id").cast("bigint").alias("id")).distinct(), "id", "left_semi")
    one = F.min_by(F.struct("list", "rotated", "v"), F.xxhash64("v")).alias("_one")
    asked = store_and_reload(wanted.groupBy("id").agg(one).select("id", "_one.*"), "asked")
    probes = store_and_reload(_probes(asked, index, sizes, k), "probes")
    asking = {r["list"]: r["count"] for r in probes.groupBy("list").count().collect()}

    def pieces(counts: dict[int, int], size: int):
        return F.element_at(F.array(*[F.lit(-(-max(1, counts.get(i, 0)) // size)).cast("bigint") for i in range(len(sizes))]), F.col("list") + 1)

    vector_blocks = pieces(dict(enumerate(held.tolist())), BLOCK_VECTORS)
    query_blocks = pieces(asking, BLOCK_QUERIES)
    asked_lists = list(asking)
    left = (
        stored.where(F.col("list").isin(asked_lists))
        .withColumn("vector_block", F.pmod(F.xxhash64("id", "v"), vector_blocks))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("bigint"), query_blocks - 1)))
    )
    right = probes.withColumn("query_block", F.pmod(F.xxhash64("id"), query_blocks)).withColumn(
        "vector_block", F.explode(F.sequence(F.lit(0).cast("bigint"), vector_blocks - 1))
    )

    def search(vectors: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(vectors) and len(asking):
            ids = vectors["id"].to_numpy()
            rotated = np.frombuffer(b"".join(vectors["rotated"]), np.float32).reshape(len(ids), -1)
            originals = np.frombuffer(b"".join(vectors["v"]), np.float64).reshape(len(ids), -1)
            blocks = [np.ascontiguousarray(rotated[:, c : c + COLUMNS]) for c in range(0, rotated.shape[1], COLUMNS)]
            for own, turned, exact, bound in zip(asking["id"], asking["rotated"], asking["v"], asking["bound"]):
                at, away = scan(
                    ids, blocks, originals, own, np.frombuffer(turned, np.float32), np.frombuffer(exact), bound, k
                )
                found.append(pd.DataFrame({"query_id": own, "vec_id": ids[at], "score": away}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    by = ["list", "vector_block", "query_block"]
    met = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(search, "query_id bigint, vec_id bigint, score double")
    seeds = _seeds(asked, index, sizes, k)
    met = met.unionByName(seeds).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    first = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return met.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def op2(embeddings: DataFrame) -> DataFrame:
    """The rows of the contract: queries are the rows whose id is divisible by 100."""
    asked = pick(embeddings, id="vec_id").where("id % 100 = 0")
    return nearest(embeddings, asked)
