"""Kafka source options, the Kafka record encoding, and a topic peek.

The Kafka connector jar is not part of every installation, so the read/write
calls are separate from the pure DataFrame transforms they feed: tests and the
driver feed Kafka-shaped DataFrames (or a file stream) into the same code.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from strata.schema import EVENT_COLUMNS

DEFAULT_TOPIC = "ecommerce-events"


def kafka_options(
    bootstrap_servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = 10_000,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Subscribe options; `max_offsets_per_trigger=None` reads without a rate limit."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions is not None:
        opts["minPartitions"] = str(int(min_partitions))
    return opts


class KafkaConnectorMissing(RuntimeError):
    """The Kafka data source is not on the classpath."""


def _is_missing_kafka(exc: AnalysisException) -> bool:
    msg = str(exc).lower()
    return "kafka" in msg and (
        "failed to find data source" in msg or "DATA_SOURCE_NOT_FOUND" in (exc.getCondition() or "")
    )


def _connector_hint(spark: SparkSession) -> str:
    return (
        "the Kafka connector is not on the classpath; start Spark with "
        f"--packages org.apache.spark:spark-sql-kafka-0-10_2.13:{spark.version}"
    )


def kafka_stream_reader(spark: SparkSession, options: dict[str, str]) -> DataStreamReader:
    return spark.readStream.format("kafka").options(**options)


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming DataFrame with the Kafka source schema (requires the connector)."""
    try:
        return kafka_stream_reader(spark, options).load()
    except AnalysisException as exc:
        if _is_missing_kafka(exc):
            raise KafkaConnectorMissing(_connector_hint(spark)) from exc
        raise


def encode_events(events: DataFrame, key_column: str = "user_id", columns: list[str] = EVENT_COLUMNS) -> DataFrame:
    """Rows → Kafka records: key = user_id (per-user ordering and
    partitioning), value = compact JSON of the event (NULL fields omitted)."""
    return events.select(
        F.col(key_column).cast("binary").alias("key"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])).cast("binary").alias("value"),
    )


def write_kafka(records: DataFrame, bootstrap_servers: str, topic: str = DEFAULT_TOPIC) -> None:
    """Batch write of encoded records (requires the connector)."""
    try:
        records.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save()
    except AnalysisException as exc:
        if _is_missing_kafka(exc):
            raise KafkaConnectorMissing(_connector_hint(records.sparkSession)) from exc
        raise


def peek(records: DataFrame) -> DataFrame:
    """Per record partition, offset, event_type, user_id and whether the
    payload is JSON at all (non-JSON payloads are flagged, not dropped)."""
    parsed = records.select("partition", "offset", F.try_parse_json(F.col("value").cast("string")).alias("json"))
    return parsed.select(
        "partition",
        "offset",
        F.try_variant_get("json", "$.event_type", "string").alias("event_type"),
        F.try_variant_get("json", "$.user_id", "string").alias("user_id"),
        F.col("json").isNotNull().alias("is_json"),
    )
