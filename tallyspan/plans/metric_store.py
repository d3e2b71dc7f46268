"""Stored daily deltas: built in one pass over the inputs, corrected by addition.

Deltas add up, so a correction is one more set of rows and nothing is rewritten.  Every attempt
of a run writes a folder of its own; the run counts when a pointer names that folder,
which is the last step.  A store of targets names the runs in its own pointer, with the rows they
stand for; ``build`` and ``correct`` are for deltas without such a store.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.operators import history, metrics
from tallyspan.operators.upsert import correction_deltas, deltas_of_touched
from tallyspan.sources.pointer import Pointer


@dataclass(frozen=True)
class MetricStore:
    root: str
    price_type: T.DataType = T.LongType()

    @property
    def delta_schema(self) -> T.StructType:
        counts = [T.StructField(n, T.LongType()) for n in metrics.ADDITIVE if n != "price"]
        price = T.StructField("price", self.price_type)
        return T.StructType([T.StructField("date", T.DateType()), T.StructField("type", T.StringType()), price, *counts])

    @property
    def pointer(self) -> Pointer:
        return Pointer(f"{self.root}/runs")

    def folder(self, attempt: str) -> str:
        return f"{self.root}/deltas/{attempt}"

    # --- folders of one attempt each; they count when a pointer names them --------------

    def write_build(self, initial: DataFrame, changes: DataFrame, by_row: bool = False) -> str:
        """The deltas of all states, from one pass over the inputs; ``by_row`` counts changes
        without a licence one by one, for ``write_touched``."""
        placed = changes.where("license_id IS NOT NULL") if by_row else changes
        deltas = metrics.interval_deltas(history.state_intervals(initial, placed, keep_hidden=True))
        return self._write(metrics.add_deltas(deltas, metrics.unplaced_days(changes)) if by_row else deltas)

    def write_correction(
        self,
        initial: DataFrame,
        known: DataFrame,
        late: DataFrame,
        late_initial: DataFrame | None = None,
        replace_entities: bool = False,
    ) -> str:
        """What late rows change; ``initial`` and ``known`` are the tables before."""
        return self._write(correction_deltas(initial, known, late, late_initial, replace_entities))

    def write_touched(
        self, entities: DataFrame, before: DataFrame, unplaced: DataFrame, late: DataFrame, late_initial: DataFrame
    ) -> str:
        """What new versions of rows change; ``entities`` and ``before`` are the stored rows of
        the licences that they touch, ``unplaced`` the older versions without a licence."""
        return self._write(deltas_of_touched(entities, before, late, late_initial, True, unplaced=unplaced))

    def write_deltas(self, deltas: DataFrame) -> str:
        """Given deltas."""
        return self._write(deltas)

    def write_merged(self, spark: SparkSession, runs: Mapping[str, str]) -> str:
        """The sum of several runs as one."""
        return self._write(self.deltas_of(spark, runs))

    def deltas_of(self, spark: SparkSession, runs: Mapping[str, str]) -> DataFrame:
        if not runs:
            return spark.createDataFrame([], self.delta_schema)
        rows = spark.read.schema(self.delta_schema).parquet(*[self.folder(f) for f in runs.values()])
        return metrics.add_deltas(rows)

    def mart_of(self, spark: SparkSession, runs: Mapping[str, str]) -> DataFrame:
        """Daily metrics; reads days x types rows per run and none of the inputs."""
        deltas = self.deltas_of(spark, runs)
        return metrics.mart_from_deltas(deltas, metrics.delta_bounds(deltas))

    # --- deltas with a pointer of their own -----------------------------------------

    def build(self, spark: SparkSession, initial: DataFrame, changes: DataFrame) -> None:
        """Run 0."""
        version, runs = self.pointer.read(spark)
        if runs:
            raise ValueError(f"{self.root} already holds deltas")
        self.pointer.publish(spark, version, {"0": self.write_build(initial, changes)})

    def correct(
        self,
        run_id: int,
        initial: DataFrame,
        known: DataFrame,
        late: DataFrame,
        late_initial: DataFrame | None = None,
    ) -> None:
        """Add what late rows change.  Running a run again replaces what it added."""
        if run_id < 1:
            raise ValueError("run 0 is the first build")
        version, runs = self.pointer.read(initial.sparkSession)
        attempt = self.write_correction(initial, known, late, late_initial)
        self.pointer.publish(initial.sparkSession, version, {**runs, str(run_id): attempt})

    def deltas(self, spark: SparkSession) -> DataFrame:
        """Sum over the runs."""
        return self.deltas_of(spark, self.pointer.read(spark)[1])

    def bounds(self, spark: SparkSession) -> DataFrame:
        return metrics.delta_bounds(self.deltas(spark))

    def mart(self, spark: SparkSession) -> DataFrame:
        return self.mart_of(spark, self.pointer.read(spark)[1])

    def _write(self, deltas: DataFrame) -> str:
        attempt = uuid.uuid4().hex
        typed = deltas.select(*[F.col(f.name).cast(f.dataType) for f in self.delta_schema.fields])
        typed.write.parquet(self.folder(attempt))
        return attempt
