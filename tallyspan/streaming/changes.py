"""Structured Streaming over the change log, file source, run to the end of the input.

Each function starts a query with an ``availableNow`` trigger and waits for it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.operators.dedup import latest_per_key
from tallyspan.plans.incremental import Store, commit, event_range, next_checkpoint, write_batch
from tallyspan.sources.pointer import Pointer


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 4) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def dedup_stream(stream: DataFrame, key: str, event_column: str, delay: str) -> DataFrame:
    """Each key once; rows older than the watermark are dropped, and the state of a key
    goes when the watermark passes it."""
    timed = stream.withColumn(event_column, F.col(event_column).cast("timestamp"))
    return timed.withWatermark(event_column, delay).dropDuplicatesWithinWatermark([key])


def daily_counts_stream(stream: DataFrame, event_column: str, type_column: str, delay: str) -> DataFrame:
    """Rows per day and type, in tumbling windows of one day."""
    timed = stream.withColumn(event_column, F.col(event_column).cast("timestamp"))
    return (
        timed.withWatermark(event_column, delay)
        .groupBy(F.window(event_column, "1 day"), type_column)
        .agg(F.count("*").alias("n_changes"))
        .select(F.to_date("window.start").alias("date"), F.col(type_column).alias("type"), "n_changes")
    )


def run_to_parquet(df: DataFrame, output: str, checkpoint: str) -> None:
    """Append mode into a parquet folder; the file sink records each batch once."""
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_updates(df: DataFrame, output: str, checkpoint: str) -> None:
    """Update mode: every batch writes the rows it changed to its own folder, so a
    batch that is run again replaces what it wrote before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    query = (
        df.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_updates(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Current value of every key from the folders of ``run_updates``."""
    return latest_per_key(updates, keys, [F.col("batch_id").desc()]).drop("batch_id")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream whose progress is in this checkpoint folder, made up when it
    is first asked for.  Batch numbers mean something only together with it."""
    pointer = Pointer(f"{checkpoint.rstrip('/')}-source")
    version, content = pointer.read(spark)
    if not version:
        content = {"source_id": uuid.uuid4().hex}
        pointer.publish(spark, 0, content)
    return content["source_id"]


def run_upserts(
    stream: DataFrame, store: Store, checkpoint: str, source_id: str | None = None, with_metrics: bool | None = None
) -> None:
    """Upsert each micro-batch of change rows into the change target of ``store``.

    The store remembers the last batch of each stream, in the same step that publishes the
    batch's rows.  A batch that is delivered again is skipped only if the same stream has
    published it; other streams and other runs on the store have no part in that.  A store
    that has metrics keeps them with every batch unless ``with_metrics`` is False.
    """
    spark = stream.sparkSession
    source = source_id or stream_id(spark, checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        state = store.state(session)
        if state.streams.get(source, -1) >= batch_id:
            return
        written = write_batch(session, store, "changes", batch, state)
        seen = event_range(session, store.targets["changes"], written["changes"])
        point = next_checkpoint(session, state.last, [(*seen, True)] if seen else [])
        commit(session, store, state, written, point, {source: batch_id}, with_metrics)

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
