"""Structured Streaming jobs.

* Bronze: Kafka (or a file stream of Kafka-shaped rows) → parse → Parquet,
  partitioned by day, append only, exactly once through the checkpoint.
* Console/memory sink for inspection.
* Watermark on event time (10 minutes). No stateful operator follows it, so
  it never drops a row: late rows pass through.
* Continuous Silver through `foreachBatch`: `row_number` is not allowed on a
  stream, so each micro-batch appends its candidates to a log, and readers
  resolve the latest row per event_id. A variant keeps the latest row per id in
  the state store, bounded by the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.packing import with_packed_texts
from strata.operators import silver as S
from strata.operators.bronze import kafka_to_bronze
from strata.session import DROP_SHUFFLES, settings
from strata.sources.sinks import with_month_partition
from strata.streaming import silver_log


def with_trigger(writer, processing_time: str | None = None, available_now: bool = False):
    if available_now:
        return writer.trigger(availableNow=True)
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    return writer


#: Offsets of one Kafka partition whose rows of one day a single task writes.
ROWS_PER_FILE = 50_000


def start_bronze_stream(
    kafka_df: DataFrame,
    path: str,
    checkpoint: str,
    partition_col: str = "event_date_parsed",
    processing_time: str | None = "10 seconds",
    available_now: bool = False,
    query_name: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> StreamingQuery:
    """Parse every micro-batch and append it to Parquet.

    `partition_col` is the reference's daily layout by default; "event_month"
    selects the coarser monthly layout for high date cardinality.
    One checkpoint per query: the offset log and the sink's commit log make
    the output exactly-once across restarts (a batch planned but not committed
    is replayed, and the sink ignores a repeat of a committed batch).
    Each micro-batch is clustered before the sink by the partition column and by runs
    of `rows_per_file` Kafka offsets: few files per day that it touches, and a day
    that holds nearly the whole batch is written by as many tasks as its offsets fill
    (adaptive execution merges the small ones up to its advisory size).
    """
    bronze = kafka_to_bronze(kafka_df)
    if partition_col == "event_month":
        bronze = with_month_partition(bronze)
    by_runs = lambda rows: rows.repartition(F.col(partition_col), F.col("partition"), F.floor(F.col("offset") / rows_per_file))
    bronze = with_packed_texts(bronze, by_runs, keep=(partition_col,))
    w = (
        bronze.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(partition_col)
    )
    if query_name:
        w = w.queryName(query_name)
    with settings(kafka_df.sparkSession, DROP_SHUFFLES):
        return with_trigger(w, processing_time, available_now).start()


def with_event_watermark(df: DataFrame, column: str = "event_timestamp", delay: str = "10 minutes") -> DataFrame:
    """Event-time watermark."""
    return df.withWatermark(column, delay)


#: How one query's watermark follows several inputs. "min": the slowest one, so no input's rows are late because another is ahead.
WATERMARK_POLICY = ("spark.sql.streaming.multipleWatermarkPolicy", "min")


def union_watermarked(streams: list[DataFrame], column: str = "event_timestamp", delay: str = "10 minutes") -> DataFrame:
    """Several inputs in one query, each with a watermark of its own; the query's
    watermark is the least of them (`WATERMARK_POLICY`, kept in its checkpoint)."""
    streams[0].sparkSession.conf.set(*WATERMARK_POLICY)
    marked = [with_event_watermark(s, column, delay) for s in streams]
    out = marked[0]
    for other in marked[1:]:
        out = out.unionByName(other)
    return out


def start_console_stream(df: DataFrame, checkpoint: str, processing_time: str | None = "5 seconds", num_rows: int = 10,
                         truncate: bool = False, fmt: str = "console", query_name: str | None = None,
                         available_now: bool = False) -> StreamingQuery:
    """Append rows to the console (or `memory`, for tests)."""
    w = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("truncate", str(truncate).lower())
        .option("numRows", str(num_rows))
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        w = w.queryName(query_name)
    return with_trigger(w, processing_time, available_now).start()


def run_until_stopped(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Block until the query ends or is interrupted; always stop it."""
    try:
        query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        query.stop()


# ------------------------------------------------------- continuous Silver


def append_silver_batch(bronze_batch: DataFrame, batch_id: int, log_path: str, query: str = "batch") -> bool:
    """Commit one Bronze micro-batch to the Silver candidate log, reduced to one row
    per event_id. Nothing that is stored is read or rewritten; see `silver_log`."""
    return silver_log.append(S.deduplicate(silver_log.candidates(bronze_batch), whole=True), batch_id, log_path, query)


def resolve_silver(spark: SparkSession, log_path: str) -> DataFrame:
    """Silver out of the candidate log."""
    return silver_log.resolve(spark, log_path)


def _log_sink(log_path: str, checkpoint: str, merge_fan: int, stateful: bool):
    key: list[str] = []

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if not key:
            key.append(silver_log.query_key(spark, checkpoint))
        if stateful:
            silver_log.append(batch, number, log_path, key[0], stateful=True)
        else:
            append_silver_batch(batch, number, log_path, key[0])
        silver_log.merge(spark, log_path, merge_fan)

    return sink


def start_silver_stream(bronze_stream: DataFrame, log_path: str, checkpoint: str, processing_time: str | None = None,
                        available_now: bool = False, merge_fan: int = silver_log.FAN) -> StreamingQuery:
    """Continuous Silver over a Bronze stream, batch by batch, without state."""
    w = bronze_stream.writeStream.foreachBatch(_log_sink(log_path, checkpoint, merge_fan, stateful=False)).option("checkpointLocation", checkpoint)
    with settings(bronze_stream.sparkSession, DROP_SHUFFLES):
        return with_trigger(w, processing_time, available_now).start()


#: State beyond memory: the state store that keeps its rows on the executors' disks and its versions in the checkpoint.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}


def start_latest_stream(bronze_stream: DataFrame, log_path: str, checkpoint: str, delay: str = "10 minutes", span: str = "1 hour",
                        processing_time: str | None = None, available_now: bool = False, merge_fan: int = silver_log.FAN) -> StreamingQuery:
    """Continuous Silver with state: only rows that are the latest of their id
    so far reach the log. State is bounded by the watermark (`silver_log.latest_rows`)."""
    with settings(bronze_stream.sparkSession, STATE_STORE | DROP_SHUFFLES):
        latest = silver_log.latest_rows(bronze_stream, delay, span)
        w = latest.writeStream.outputMode("update").foreachBatch(_log_sink(log_path, checkpoint, merge_fan, stateful=True)).option("checkpointLocation", checkpoint)
        return with_trigger(w, processing_time, available_now).start()


# ------------------------------------------------------------------ CLI


def main(argv: list[str] | None = None) -> None:
    """python -m strata.streaming.jobs {bronze,console} --bootstrap HOST:PORT --checkpoint DIR [--path DIR]

    bronze:  Kafka → Bronze Parquet, 10 s trigger, 10,000 offsets per batch.
    console: Kafka → parsed rows with a 10-minute watermark → console, 5 s trigger.
    Both stop cleanly on Ctrl-C. Requires the Kafka connector on the classpath.
    """
    import argparse

    from strata.operators.bronze import to_console_rows
    from strata.sources import kafka

    ap = argparse.ArgumentParser(description="Structured Streaming jobs")
    ap.add_argument("job", choices=["bronze", "console"])
    ap.add_argument("--bootstrap", required=True)
    ap.add_argument("--topic", default=kafka.DEFAULT_TOPIC)
    ap.add_argument("--checkpoint", required=True, help="one checkpoint folder per query")
    ap.add_argument("--path", help="Bronze output folder (bronze job)")
    ap.add_argument("--partition-col", default="event_date_parsed", choices=["event_date_parsed", "event_month"])
    ap.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE, help="Kafka offsets whose rows of one day share a file")
    ap.add_argument("--trigger", help="processing time (default: 10 seconds for bronze, 5 seconds for console)")
    ap.add_argument("--max-offsets", type=int, help="offsets per batch, 0 for no limit (default: 10000 for bronze, none for console)")
    ap.add_argument("--starting-offsets", default="earliest")
    ap.add_argument("--fail-on-data-loss", action="store_true")
    ap.add_argument("--min-partitions", type=int, help="read a Kafka partition by several tasks")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    limit = a.max_offsets if a.max_offsets is not None else (10_000 if a.job == "bronze" else 0)
    options = kafka.kafka_options(a.bootstrap, a.topic, a.starting_offsets, a.fail_on_data_loss, limit or None, a.min_partitions)
    src = kafka.read_kafka_stream(spark, options)
    if a.job == "bronze":
        query = start_bronze_stream(src, a.path, a.checkpoint, partition_col=a.partition_col, processing_time=a.trigger or "10 seconds", rows_per_file=a.rows_per_file)
    else:
        query = start_console_stream(with_event_watermark(to_console_rows(src)), a.checkpoint, processing_time=a.trigger or "5 seconds")
    run_until_stopped(query)


if __name__ == "__main__":
    main()
