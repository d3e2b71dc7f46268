"""The rows that stand behind stored metrics, in hash buckets of the licence.

A correction needs the whole history of the licences that new rows touch, and the licences
that older versions of these rows belong to.  Three tables give both without a scan: entities and
changes in buckets of the licence, and ``places``, which says in buckets of a change's id which licence
has it.  They hold exactly what the metrics cover, so a correction may come some runs later.

A change that moves to another licence leaves a row marked ``gone`` in the old bucket, so
every bucket can be read by itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.operators.skew import BROADCAST_KEYS, rows_of_keys
from tallyspan.schemas import CHANGES_SCHEMA, INITIAL_SCHEMA
from tallyspan.session import store_and_reload
from tallyspan.sources.targets import BUCKET, COMMIT, WRITTEN, Target

LEAST_BUCKETS = 16
MOST_BUCKETS = 1 << 14
BUCKET_BYTES = 64 << 20
REBUILD_GROWTH = 4
PLACES_SCHEMA = T.StructType([CHANGES_SCHEMA["id"], CHANGES_SCHEMA["license_id"], CHANGES_SCHEMA["date"]])
MOVING_SCHEMA = T.StructType([*CHANGES_SCHEMA.fields, T.StructField("gone", T.BooleanType())])


def buckets_for(size: int) -> int:
    """A power of two, so that buckets hold about ``BUCKET_BYTES``."""
    wanted = LEAST_BUCKETS
    while wanted < MOST_BUCKETS and wanted * BUCKET_BYTES < size:
        wanted *= 2
    return wanted


@dataclass(frozen=True)
class HistoryStore:
    root: str
    buckets: int

    @property
    def tables(self) -> dict[str, Target]:
        def table(name: str, schema: T.StructType, day: str, by: str) -> Target:
            return Target(f"{self.root}/{self.buckets}/{name}", schema, day, bucket_column=by, buckets=self.buckets)

        return {
            "history_entities": table("entities", INITIAL_SCHEMA, "creation_date", "id"),
            "history_changes": table("changes", MOVING_SCHEMA, "date", "license_id"),
            "history_places": table("places", PLACES_SCHEMA, "date", "id"),
        }

    def _write(self, spark: SparkSession, rows: Mapping[str, DataFrame], sequence: int, run: int) -> dict[str, str]:
        return {name: self.tables[name].write(spark, df, sequence, run) for name, df in rows.items()}

    def write_build(self, spark: SparkSession, initial: DataFrame, changes: DataFrame, sequence: int, run: int) -> dict[str, str]:
        """Segments of all rows (one per id)."""
        rows = {
            "history_entities": initial,
            "history_changes": changes.withColumn("gone", F.lit(False)),
            "history_places": changes.select("id", "license_id", "date"),
        }
        return self._write(spark, rows, sequence, run)

    def rows_of(self, spark: SparkSession, segments: Mapping[str, Sequence[str]], name: str, keys: DataFrame, key: str) -> DataFrame:
        """The newest rows of a table whose bucket column is among ``keys`` (stored, one row
        per key, without nulls), from the buckets of these keys."""
        target = self.tables[name]
        touched = [r[0] for r in keys.select(target.bucket_of(key)).distinct().collect()]
        found = target.newest(target.versions(spark, segments.get(name, ()), touched))
        return rows_of_keys(found, keys.withColumnRenamed(key, target.bucket_column), target.bucket_column, target.key)

    def before(
        self, spark: SparkSession, segments: Mapping[str, Sequence[str]], late: DataFrame, late_initial: DataFrame
    ) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(entities, changes, places): the stored rows of all licences that the late rows
        touch, now or by an older version, and what is known of the ids of the late changes."""
        ids = store_and_reload(late.select("id").distinct(), "ids")
        places = self.rows_of(spark, segments, "history_places", ids, "id").select("id", "license_id")
        places = store_and_reload(places, "places")
        licences = late.select("license_id").union(places.select("license_id")).union(late_initial.select("id"))
        touched = store_and_reload(licences.where("license_id IS NOT NULL").distinct(), "touched")
        changes = self.rows_of(spark, segments, "history_changes", touched, "license_id").where("NOT gone")
        entities = self.rows_of(spark, segments, "history_entities", touched, "license_id")
        own = [COMMIT, WRITTEN, BUCKET]
        return (
            store_and_reload(entities.drop(*own), "entities"),
            store_and_reload(changes.drop("gone", *own), "before"),
            places,
        )

    def unplaced(self, spark: SparkSession, segments: Mapping[str, Sequence[str]], places: DataFrame) -> DataFrame:
        """The stored changes without a licence among those that ``places`` names."""
        target = self.tables["history_changes"]
        lost = places.where("license_id IS NULL").select("id")
        names = [f.name for f in CHANGES_SCHEMA.fields]
        if lost.isEmpty():
            return spark.createDataFrame([], CHANGES_SCHEMA)
        bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(None).cast("long")), F.lit(self.buckets)).cast("int")).first()[0]
        found = target.newest(target.versions(spark, segments.get("history_changes", ()), [bucket]))
        return rows_of_keys(found.where("license_id IS NULL AND NOT gone"), lost, "id", "id").select(*names)

    def write_late(
        self, spark: SparkSession, places: DataFrame, late: DataFrame, late_initial: DataFrame, sequence: int, run: int
    ) -> dict[str, str]:
        """Segments of the late rows, and of the places that they leave."""
        old = places.select("id", F.col("license_id").alias("_old"))
        small = places.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
        left = late.join(F.broadcast(old) if small else old, "id").where(~F.col("_old").eqNullSafe(F.col("license_id")))
        names = [f.name for f in CHANGES_SCHEMA.fields]
        gone = left.select(*[F.col("_old").alias(n) if n == "license_id" else F.col(n) for n in names], F.lit(True).alias("gone"))
        rows = {
            "history_entities": late_initial,
            "history_changes": late.select(*names, F.lit(False).alias("gone")).unionByName(gone),
            "history_places": late.select("id", "license_id", "date"),
        }
        return self._write(spark, rows, sequence, run)
