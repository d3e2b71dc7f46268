"""Licence tables derived from the generated star schema.

``dense`` reads ``events`` (many changes per licence and day), ``sparse`` reads
``orders`` (few changes over years).  Entities have one row per licence of the
changes; the ``edge`` variant adds changes before creation and orphan changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.schemas import UNIT_PRICES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def type_by_remainder(key: str) -> str:
    return f"CASE {key} % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'SIM' ELSE 'SUPERVISION' END"


def list_price(kind: str) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {price}L" for name, price in UNIT_PRICES.items())
    return f"CASE {kind} {cases} END"


def event_changes(events: DataFrame) -> DataFrame:
    kind = type_by_remainder("event_id")
    return events.selectExpr(
        "event_id AS id",
        "user_id AS license_id",
        "date(ts) AS date",
        f"{list_price(kind)} AS price",
        f"{kind} AS type",
        "event_type <> 'error' AS renewable",
    )


def dense_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_changes(table(spark, sf_dir, "events"))


def sparse_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = """CASE o_orderpriority WHEN '1-URGENT' THEN 'SUPERVISION' WHEN '2-HIGH' THEN 'SIM'
              WHEN '3-MEDIUM' THEN 'SIM' ELSE 'PASS' END"""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "o_custkey AS license_id",
        "date(o_orderdate) AS date",
        f"{list_price(kind)} AS price",
        f"{kind} AS type",
        "o_orderstatus <> 'F' AS renewable",
    )


def entities(changes: DataFrame, variant: str = "plain") -> DataFrame:
    first = changes.groupBy("license_id").agg(F.min("date").alias("first_date"))
    created = "date_sub(first_date, 2)"
    if variant == "edge":
        created = f"if(license_id % 3 = 0, date_add(first_date, 3), {created})"
        first = first.where("license_id % 7 <> 5")
    kind = type_by_remainder("license_id")
    return first.selectExpr(
        "license_id AS id",
        "license_id % 40 AS customer_id",
        f"{kind} AS type",
        f"{created} AS creation_date",
        f"{list_price(kind)} AS price",
        "true AS renewable",
    )


def dense(spark: SparkSession, sf_dir: str, variant: str = "plain") -> tuple[DataFrame, DataFrame]:
    changes = dense_changes(spark, sf_dir)
    return entities(changes, variant), changes


def sparse(spark: SparkSession, sf_dir: str, variant: str = "plain") -> tuple[DataFrame, DataFrame]:
    changes = sparse_changes(spark, sf_dir)
    return entities(changes, variant), changes


def with_gaps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``dense edge`` in which error events have no type and price, and every 97th
    event has no ``renewable``."""
    initial, _ = dense(spark, sf_dir, "edge")
    kind = f"if(event_type <> 'error', {type_by_remainder('event_id')}, NULL)"
    changes = table(spark, sf_dir, "events").selectExpr(
        "event_id AS id",
        "user_id AS license_id",
        "date(ts) AS date",
        f"{list_price(kind)} AS price",
        f"{kind} AS type",
        "if(event_id % 97 <> 0, event_type <> 'error', NULL) AS renewable",
    )
    return initial, changes


def with_faults(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``dense edge`` with unknown types, prices out of range and repeated ids.

    Both tables get a column ``ord``: 0 for the first row of an id, 1 for a repeat.
    """
    initial, changes = dense(spark, sf_dir, "edge")
    changes = changes.withColumns(
        {
            "type": F.when(F.col("id") % 101 == 0, "INVALID").otherwise(F.col("type")),
            "price": F.when(F.col("id") % 103 == 0, F.lit(6000).cast("long")).otherwise(F.col("price")),
            "ord": F.lit(0).cast("long"),
        }
    )
    again = changes.where("id % 50 = 0").withColumn("ord", F.lit(1).cast("long"))
    initial = initial.withColumn("ord", F.lit(0).cast("long"))
    later = initial.where("id % 20 = 0").withColumns(
        {"creation_date": F.date_add("creation_date", 10), "ord": F.lit(1).cast("long")}
    )
    return initial.unionByName(later), changes.unionByName(again)
