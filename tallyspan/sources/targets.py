"""Keyed tables as appended segments that are merged when read.

A commit writes its rows once, as a segment of its own.  Nothing that is stored is read or written
again: the newest version of a key has its row.  Which segments count, and in which order, is
said by the store's pointer, so a segment that was never published is not seen.

A table's segments have a folder per month of the event, in files sorted by day, or a folder per
hash bucket of one column, so that the rows of some values of it are found by their buckets and
nothing else is read.

Now and then the newest segments are written as one: those that are not larger than the
newest, by steps of ``FAN``, once there are ``FAN`` of them.  So a row is written again about once
for each time that the table grows ``FAN``-fold, and a large old segment is left alone by
small new ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.operators.dedup import latest_per_key
from tallyspan.sources.files import folder_bytes

DAY = "event_day"
MONTH = "event_month"
BUCKET = "bucket"
COMMIT = "commit"
WRITTEN = "written"
UNDATED = "undated"
FAN = 8
LEAST_BYTES = 1 << 16  # smaller segments count as equally large


def tier(size: int) -> int:
    """0 up to ``LEAST_BYTES``, then one more for every ``FAN``-fold."""
    steps, limit = 0, LEAST_BYTES
    while size > limit:
        steps, limit = steps + 1, limit * FAN
    return steps


def newest_to_merge(sizes: Sequence[int]) -> int:
    """How many of the newest segments (the last ones) are to be written as one; 0 for none."""
    if not sizes:
        return 0
    top = tier(sizes[-1])
    alike = 0
    for size in reversed(sizes):
        if tier(size) > top:
            break
        alike += 1
    return alike if alike >= FAN else 0


@dataclass(frozen=True)
class Target:
    """``bucket_column`` and ``buckets`` for folders by hash, else by month of the date.  With
    ``keep_versions`` merging keeps every version of a key, so older states can be read."""

    path: str
    schema: T.StructType
    date_column: str
    key: str = "id"
    keep_versions: bool = False
    bucket_column: str | None = None
    buckets: int = 0

    @property
    def folder_column(self) -> str:
        return BUCKET if self.bucket_column else MONTH

    @property
    def stored_schema(self) -> T.StructType:
        kind = T.IntegerType() if self.bucket_column else T.StringType()
        own = [T.StructField(WRITTEN, T.LongType()), T.StructField(COMMIT, T.StringType()), T.StructField(self.folder_column, kind)]
        return T.StructType([*self.schema.fields, *own])

    def folder(self, segment: str) -> str:
        return f"{self.path}/{COMMIT}={segment}"

    def bytes_of(self, spark: SparkSession, segment: str) -> int:
        return folder_bytes(spark, self.folder(segment))

    def bucket_of(self, column: str | None = None) -> Column:
        return F.pmod(F.xxhash64(column or self.bucket_column), F.lit(self.buckets)).cast("int")

    def versions(self, spark: SparkSession, segments: Sequence[str], buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of these segments as they were written, with the run that wrote them; of
        these buckets only, if given."""
        if segments:
            reader = spark.read.schema(self.stored_schema).option("basePath", self.path)
            rows = reader.parquet(*map(self.folder, segments))
        else:
            rows = spark.createDataFrame([], self.stored_schema)
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))

    def segment(self, spark: SparkSession, segments: Sequence[str]) -> DataFrame:
        """Rows of these segments with ``event_day``."""
        return self.versions(spark, segments).drop(WRITTEN, self.folder_column).withColumn(DAY, self._day())

    def _day(self) -> Column:
        return F.coalesce(F.col(self.date_column).cast("date").cast("string"), F.lit(UNDATED))

    def newest(self, rows: DataFrame) -> DataFrame:
        """One row per key (and bucket) of ``versions``, the one written last; a row that
        takes its key away from a bucket gives way to one of the same run."""
        keys = [self.key, *([BUCKET] if self.bucket_column else [])]
        gone = [F.col("gone").asc()] if "gone" in self.schema.fieldNames() else []
        return latest_per_key(rows, keys, [F.col(WRITTEN).desc(), *gone])

    def read(self, spark: SparkSession, segments: Sequence[str], run: int | None = None) -> DataFrame:
        """One row per key with ``event_day``: the newest version, or that of a run.

        The first segment, by far the largest as a rule, is only filtered by the
        keys of the others, and not shuffled if these are few.
        """
        own = [COMMIT, WRITTEN, self.folder_column]
        if run is not None or self.keep_versions:
            rows = self.versions(spark, segments)
            found = self.newest(rows if run is None else rows.where(F.col(WRITTEN) <= run))
        elif len(segments) < 2:
            found = self.versions(spark, segments)
        else:
            first, later = self.versions(spark, segments[:1]), self.newest(self.versions(spark, segments[1:]))
            found = first.join(later.select(self.key), self.key, "left_anti").select(*later.columns).unionByName(later)
        return found.drop(*own).withColumn(DAY, self._day())

    def write(self, spark: SparkSession, rows: DataFrame, sequence: int, run: int) -> str:
        """Stores ``rows`` (one per key) as a segment and gives its name.  Rows that have
        been written before keep their run.  The rebalance
        hint lets AQE split a hot folder over tasks and put small ones together."""
        segment = f"{sequence:012d}-{uuid.uuid4().hex}"
        place = self.bucket_of() if self.bucket_column else F.substring(self._day(), 1, 7)
        written = F.col(WRITTEN) if WRITTEN in rows.columns else F.lit(run).cast("long")
        (
            rows.select(*self.schema.fieldNames(), written.alias(WRITTEN), place.alias(self.folder_column))
            .hint("rebalance", self.folder_column)
            .sortWithinPartitions(self.folder_column, self.date_column, self.key)
            .write.partitionBy(self.folder_column)
            .parquet(self.folder(segment))
        )
        return segment

    def write_merged(self, spark: SparkSession, segments: Sequence[str], sequence: int, from_first: bool) -> str:
        """These neighbouring segments as one.  What takes keys away has nothing
        left to do if the first segment is among them."""
        rows = self.versions(spark, segments)
        if not self.keep_versions:
            rows = self.newest(rows)
            if from_first and "gone" in self.schema.fieldNames():
                rows = rows.where("NOT gone")
        return self.write(spark, rows.drop(COMMIT), sequence, 0)

    def touched_days(self, spark: SparkSession, segment: str) -> list[str]:
        """Days that a segment has rows of; bounded by the calendar."""
        return sorted(r[0] for r in self.segment(spark, [segment]).select(DAY).distinct().collect())
