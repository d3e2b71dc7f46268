"""Daily metrics from streams of entities and changes, kept by state per licence.

The state of a licence is its history: at most one row per calendar day.  A batch's rows change it, and
what that changes in the daily deltas, new less old, goes out signed; so no batch reads a table.
The sum of all that went out is what one computation over all rows gives.  Rows that are
delivered again change nothing.  A task first reduces its rows to one per licence and day, so a
licence with a large share of a batch sends few of them to its state.

The histories of the licences of a bucket, by a hash, are one value of the state: reading, merging and
comparing them are operations on columns of thousands of rows instead of a call per licence.  A
batch reads and writes the buckets that its rows touch.  A stream keeps its number of buckets, which
is written beside its checkpoint when it starts; about a thousand licences a bucket are a good number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tallyspan.operators import metrics
from tallyspan.plans.metric_store import MetricStore
from tallyspan.sources.pointer import Pointer
from tallyspan.streaming.changes import stream_id

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
MERGE_AFTER = 8  # runs of deltas
BUCKETS = 1024
LEAST_ID = -(2**63)
ROW = "licence string, day int, is_change boolean, id bigint, renewable int, price bigint, has_price boolean, type string"
DELTAS = T.StructType(
    [T.StructField("day", T.IntegerType()), T.StructField("type", T.StringType()), *[T.StructField(m, T.LongType()) for m in metrics.ADDITIVE]]
)


def licence_rows(entities: DataFrame | None, changes: DataFrame) -> DataFrame:
    """Both tables as one: the licence as text, "" for none, the day as a number."""

    def rows(df: DataFrame, licence: str, date: str, is_change: bool) -> DataFrame:
        return df.where(F.col(date).isNotNull()).select(
            F.coalesce(F.col(licence).cast("string"), F.lit("")).alias("licence"),
            F.unix_date(F.col(date).cast("date")).alias("day"),
            F.lit(is_change).alias("is_change"),
            (F.coalesce("id", F.lit(LEAST_ID)) if is_change else F.lit(-1)).cast("long").alias("id"),
            F.coalesce(F.col("renewable").cast("int"), F.lit(-1)).alias("renewable"),
            F.coalesce(F.col("price").cast("long"), F.lit(0)).alias("price"),
            F.col("price").cast("long").isNotNull().alias("has_price"),
            "type",
        )

    logged = rows(changes, "license_id", "date", True)
    return logged if entities is None else logged.unionByName(rows(entities, "id", "creation_date", False))


def newest_per_task(rows: DataFrame) -> DataFrame:
    """One row per licence, day and kind from each batch of a task: the one that wins."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = ["licence", "day", "is_change"]
        for batch in batches:
            best = batch.groupby(keys)["id"].transform("max")
            yield batch[batch["id"] == best].drop_duplicates()

    return rows.mapInPandas(run, ROW)


def licence_histories() -> StatefulProcessor:
    """The processor of one bucket of licences.  Nothing in it refers to this package, which
    workers need not have."""
    import numpy as np
    import pyarrow as pa

    measures = metrics.MEASURES
    additive = list(metrics.ADDITIVE)
    state_type = T.StructType([T.StructField("rows", T.BinaryType())])
    columns = [f.name for f in DELTAS.fields]
    held = ["licence", "day", "is_change", "id", "renewable", "price", "has_price", "type", "has_entity"]

    def unpacked(data: bytes) -> pd.DataFrame:
        return pa.ipc.open_stream(data).read_all().to_pandas()

    def packed(rows: pd.DataFrame) -> bytes:
        table = pa.Table.from_pandas(rows, preserve_index=False).replace_schema_metadata(None)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
            writer.write_table(table)
        return sink.getvalue().to_pybytes()

    def merged(parts: list) -> pd.DataFrame:
        """The newest row of each licence and day, and whether an entity was created there; in this order."""
        rows = pd.concat(parts, ignore_index=True)
        rows["has_type"] = rows["type"].notna()
        kind = rows["type"].factorize(sort=True)[0]
        licence = rows["licence"].factorize()[0]
        by = [kind, rows["price"], rows["has_price"], rows["renewable"], rows["id"], rows["is_change"], rows["day"], licence]
        order = np.lexsort([np.asarray(column) for column in by])
        rows, licence = rows.iloc[order], licence[order]
        day = rows["day"].to_numpy()
        last = np.append((licence[1:] != licence[:-1]) | (day[1:] != day[:-1]), True)
        first = np.flatnonzero(np.append(True, last[:-1]))
        entity = np.logical_or.reduceat(rows["has_entity"].to_numpy(bool), first)
        return rows[last].assign(has_entity=entity)[held].reset_index(drop=True)

    def deltas(rows: pd.DataFrame, sign: int) -> pd.DataFrame:
        """What the intervals between the states add, a row for each start and end; ``rows`` in the
        order of ``merged``."""
        licence, day = rows["licence"].factorize()[0], rows["day"].to_numpy()
        start = np.append(True, licence[1:] != licence[:-1])
        place = np.arange(len(rows))
        begin = np.maximum.accumulate(np.where(start, place, 0))
        entity = rows["has_entity"].to_numpy(bool) & (rows["licence"] != "").to_numpy(bool)
        created = np.maximum.accumulate(np.where(entity, place, -1)) >= begin
        renewable, priced = rows["renewable"].to_numpy(), rows["has_price"].to_numpy(bool)
        shown, active = created & (renewable >= 0), renewable == 1
        own = {
            "members": np.ones(len(rows), np.int64),
            "active": active.astype(np.int64),
            "inactive": (~active).astype(np.int64),
            "price": np.where(active, rows["price"].to_numpy(), 0),
            "priced": (~(active & ~priced)).astype(np.int64),
        }
        assert list(own) == measures
        kind = rows["type"].where(shown, None)
        began = pd.DataFrame({"day": day, "type": kind, **{m: np.where(shown, sign * own[m], 0) for m in measures}})
        began["starts"], began["states"] = np.where(shown, sign, 0), sign
        more = np.flatnonzero(shown[:-1] & ~start[1:])
        ended = pd.DataFrame({"day": day[more + 1], "type": kind.iloc[more].to_numpy(), **{m: -sign * own[m][more] for m in measures}})
        ended["starts"], ended["states"] = 0, 0
        return pd.concat([began, ended], ignore_index=True)

    def summed(parts: list) -> pd.DataFrame:
        rows = pd.concat(parts, ignore_index=True)
        if rows["price"].abs().max() > 2**62 // len(rows):
            rows["price"] = rows["price"].astype(object)  # a sum beyond 64 bits is an error, not another number
        sums = rows.groupby(["day", "type"], dropna=False, sort=False)[additive].sum().reset_index()
        sums["type"] = sums["type"].astype(object).where(sums["type"].notna(), None)
        return sums[(sums[additive] != 0).any(axis=1)][columns]

    class Histories(StatefulProcessor):
        def init(self, handle) -> None:
            self.stored = handle.getValueState("histories", state_type)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            late = merged([frame.assign(has_entity=~frame["is_change"].astype(bool))[held] for frame in rows])
            known = unpacked(self.stored.get()[0]) if self.stored.exists() else late.iloc[:0]
            touched = known["licence"].isin(late["licence"].unique())
            before, others = known[touched], known[~touched]
            after = merged([before, late]) if len(before) else late
            self.stored.update((packed(pd.concat([others, after], ignore_index=True) if len(others) else after),))
            yield summed([deltas(part, sign) for part, sign in ((after, 1), (before, -1)) if len(part)])

        def close(self) -> None:
            pass

    return Histories()


def live_deltas(entities: DataFrame | None, changes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Streams of rows to a stream of signed deltas."""
    rows = newest_per_task(licence_rows(entities, changes))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("licence"), F.lit(buckets)))
    moved = dealt.groupBy("bucket").transformWithStateInPandas(licence_histories(), DELTAS, "Append", "None")
    return moved.withColumn("date", F.date_from_unix_date("day")).drop("day")


def stream_buckets(spark: SparkSession, checkpoint: str, buckets: int) -> int:
    """How many buckets the state in this checkpoint folder has; ``buckets`` for a new one."""
    pointer = Pointer(f"{checkpoint.rstrip('/')}-buckets")
    version, content = pointer.read(spark)
    if not version:
        content = {"buckets": buckets}
        pointer.publish(spark, 0, content)
    return content["buckets"]


def run_live_mart(
    entities: DataFrame | None, changes: DataFrame, store: MetricStore, checkpoint: str, buckets: int = BUCKETS
) -> None:
    """Adds the deltas of every batch to ``store``, whose ``mart`` is up to date after each.

    A batch's folder counts when the store's pointer names it, under the stream's name and the batch's
    number, so a batch that is run again is skipped.  The deltas of many batches become one.
    """
    spark = changes.sparkSession
    source = stream_id(spark, checkpoint)
    buckets = stream_buckets(spark, checkpoint, buckets)

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        version, runs = store.pointer.read(session)
        name = f"{source}-{batch_id:012d}"
        if any(n.startswith(f"{source}-") and n >= name for n in runs):
            return
        runs = {**runs, name: store.write_deltas(metrics.add_deltas(batch))}
        if len(runs) > MERGE_AFTER:
            own = {n: f for n, f in runs.items() if n.startswith(f"{source}-")}
            runs = {n: f for n, f in runs.items() if n not in own} | {name: store.write_merged(session, own)}
        store.pointer.publish(session, version, runs)

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS_DB)  # what the state of this operator needs
    try:
        query = (
            live_deltas(entities, changes, buckets)
            .writeStream.foreachBatch(apply)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
