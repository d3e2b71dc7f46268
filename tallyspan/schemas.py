"""Table schemas and the fixed values of the licence domain."""

from __future__ import annotations

from pyspark.sql import types as T

INITIAL_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("creation_date", T.DateType()),
        T.StructField("price", T.LongType()),
        T.StructField("renewable", T.BooleanType()),
    ]
)

CHANGES_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("license_id", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("price", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("renewable", T.BooleanType()),
    ]
)

CHECKPOINT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("last_data_timestamp", T.TimestampType()),
        T.StructField("last_processed_timestamp", T.TimestampType()),
    ]
)

MART_COLUMNS = [
    "date",
    "type",
    "active_license_count",
    "active_license_price",
    "inactive_license_count",
    "daily_active_diff",
    "daily_price_diff",
    "daily_inactive_diff",
]

# The accepted licence types with their yearly price, the accepted
# price range, and the id that marks a state taken from the entity table.
UNIT_PRICES = {"PASS": 100, "SIM": 1000, "SUPERVISION": 5000}
MIN_PRICE = 0
MAX_PRICE = 5000
INITIAL_STATE_ID = -1
