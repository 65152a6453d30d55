"""Event-specific payload fields beyond the 25-field record.

The record schema stays fixed; a caller who needs the extra fields of a given
event type (page, durations, order id, payment method, failure reason, …)
parses them from the raw JSON with a wider schema instead of widening Bronze.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from strata.schema import EVENT_SCHEMA

# The event-specific fields a producer may send besides the record.
PAYLOAD_SCHEMA = StructType(
    [
        StructField("page", StringType()),
        StructField("duration_seconds", DoubleType()),
        StructField("view_duration_seconds", DoubleType()),
        StructField("cart_quantity", IntegerType()),
        StructField("order_id", StringType()),
        StructField("payment_method", StringType()),
        StructField("purchase_status", StringType()),
        StructField("failure_reason", StringType()),
    ]
)

WIDE_EVENT_SCHEMA = StructType(EVENT_SCHEMA.fields + PAYLOAD_SCHEMA.fields)


def extract_payload(df: DataFrame, json_column: str, schema: StructType | str = PAYLOAD_SCHEMA) -> DataFrame:
    """Add the payload fields parsed from `json_column` as top-level columns."""
    parsed = F.from_json(F.col(json_column), schema)
    return df.withColumn("_payload", parsed).select("*", "_payload.*").drop("_payload")
