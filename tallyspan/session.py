"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The plans rely on AQE to size shuffles and to split skewed write partitions (the
# rebalance hint).  Streaming state of many keys belongs on disk, not on the heap.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "tallyspan", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the folder that all executors share; ``clear_scratch`` deletes
    what has been written there.

    The cluster names that folder in ``spark.checkpoint.dir``.  Only a local
    master may fall back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="tallyspan-")
    path = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this process.  A lazy result may still read
    them, so this is for the end of a job, when its results are stored."""
    while _made:
        target = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def store_and_reload(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here
    and every later read sees the same rows in the same files."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
