"""Declared schemas and column lists of the event, Bronze and Silver layers.

Nothing is inferred: the event struct is the `from_json` target, the Bronze and
Silver column lists fix the projection (and order) of each layer.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Fixed values that must equal the reference's contract: field names, order
# and types of the 25-field event record.
EVENT_SCHEMA = StructType(
    [
        StructField("event_id", StringType()),
        StructField("user_id", StringType()),
        StructField("session_id", StringType()),
        StructField("event_type", StringType()),
        StructField("timestamp", StringType()),
        StructField("event_date", StringType()),
        StructField("device", StringType()),
        StructField("traffic_source", StringType()),
        StructField("customer_name", StringType()),
        StructField("segment", StringType()),
        StructField("country", StringType()),
        StructField("market", StringType()),
        StructField("region", StringType()),
        StructField("product_id", StringType()),
        StructField("category", StringType()),
        StructField("sub_category", StringType()),
        StructField("product_name", StringType()),
        StructField("product_price", DoubleType()),
        StructField("quantity", IntegerType()),
        StructField("discount_percent", DoubleType()),
        StructField("sales", DoubleType()),
        StructField("ship_mode", StringType()),
        StructField("order_priority", StringType()),
        StructField("removed_quantity", IntegerType()),
        StructField("search_query", StringType()),
    ]
)
EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

# The fields a raw record must carry (record validation).
REQUIRED_FIELDS = ["event_id", "user_id", "session_id", "event_type", "timestamp", "product_id"]

# The fields the Silver keep-rule requires non-null and non-blank.
SILVER_REQUIRED = ["event_id", "user_id", "session_id", "event_type", "product_id"]

KAFKA_META_SCHEMA = StructType(
    [
        StructField("kafka_key", StringType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("kafka_timestamp", TimestampType()),
    ]
)

BRONZE_SCHEMA = StructType(
    KAFKA_META_SCHEMA.fields
    + EVENT_SCHEMA.fields
    + [
        StructField("event_timestamp", TimestampType()),
        StructField("event_date_parsed", DateType()),
    ]
)
BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]

# Public shape of the Kafka source (key/value are bytes).
KAFKA_SOURCE_SCHEMA = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

SILVER_SCHEMA = StructType(
    [
        StructField("kafka_key", StringType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("kafka_timestamp", TimestampType()),
        StructField("event_id", StringType()),
        StructField("user_id", StringType()),
        StructField("session_id", StringType()),
        StructField("event_type", StringType()),
        StructField("timestamp", StringType()),
        StructField("event_timestamp", TimestampType()),
        StructField("event_date", DateType()),
        StructField("device", StringType()),
        StructField("traffic_source", StringType()),
        StructField("customer_name", StringType()),
        StructField("segment", StringType()),
        StructField("country", StringType()),
        StructField("market", StringType()),
        StructField("region", StringType()),
        StructField("product_id", StringType()),
        StructField("category", StringType()),
        StructField("sub_category", StringType()),
        StructField("product_name", StringType()),
        StructField("product_price", DoubleType()),
        StructField("quantity", IntegerType()),
        StructField("removed_quantity", IntegerType()),
        StructField("net_quantity", IntegerType()),
        StructField("discount_percent", DoubleType()),
        StructField("discount_amount", DoubleType()),
        StructField("sales", DoubleType()),
        StructField("ship_mode", StringType()),
        StructField("order_priority", StringType()),
        StructField("search_query", StringType()),
    ]
)
SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]

# Columns standardised by the Silver layer.
TRIM_COLUMNS = [
    "event_id",
    "user_id",
    "session_id",
    "timestamp",
    "customer_name",
    "segment",
    "country",
    "market",
    "region",
    "product_id",
    "category",
    "sub_category",
    "product_name",
    "search_query",
]
LOWER_TRIM_COLUMNS = ["event_type", "device", "traffic_source", "ship_mode", "order_priority"]


def ddl(schema: StructType) -> str:
    """Column list for CREATE TABLE, reserved words back-quoted."""
    return ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
