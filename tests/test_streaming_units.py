"""Streaming units: memory/console sink, graceful stop, watermark pass-through,
and the DDL / smoke helpers."""

from pyspark.sql import functions as F

from strata.schema import BRONZE_SCHEMA
from strata.session import scratch_path
from strata.sources import sinks
from strata.streaming import jobs


def test_memory_sink_and_stop(spark):
    src = scratch_path(spark, "test-mem-src")
    spark.range(20).withColumn("event_timestamp", F.timestamp_seconds(F.col("id") * 60)).write.parquet(src)
    stream = spark.readStream.schema("id long, event_timestamp timestamp").parquet(src)
    q = jobs.start_console_stream(jobs.with_event_watermark(stream), scratch_path(spark, "test-mem-ckpt"), fmt="memory",
                                  query_name="strata_mem", available_now=True)
    jobs.run_until_stopped(q)
    assert spark.table("strata_mem").count() == 20
    assert not q.isActive


def test_create_table_sql_quotes_reserved_names():
    sql = sinks.create_table_sql("bronze_events", BRONZE_SCHEMA)
    assert sql.startswith("CREATE TABLE IF NOT EXISTS bronze_events (")
    for name in ("`partition` INT", "`offset` BIGINT", "`timestamp` STRING", "`event_date_parsed` DATE"):
        assert name in sql
    assert sql.rstrip().endswith("USING parquet")


def test_smoke_rows_round_trip(spark):
    df = spark.createDataFrame([(1, "spark", 100.0), (2, "s3", 200.0), (3, "test", 300.0)], ["id", "name", "value"])
    back = sinks.round_trip(df, scratch_path(spark, "test-smoke"))
    assert back.count() == 3 and spark.range(10).count() == 10


def test_guards(spark):
    import pytest

    with pytest.raises(RuntimeError):
        sinks.assert_not_empty(spark.range(0), "x")
    with pytest.raises(RuntimeError):
        sinks.assert_bounded(5, 4)


def test_publish_replaces(spark):
    base = scratch_path(spark, "test-tables")
    sinks.publish(spark.range(5), "strata_t_replace", base)
    _, n = sinks.publish(spark.range(7), "strata_t_replace", base)
    assert n == 7 and spark.table("strata_t_replace").count() == 7


def test_console_row_shape(spark):
    from strata.operators.bronze import to_console_rows
    from strata.schema import EVENT_COLUMNS

    rec = spark.createDataFrame(
        [(b"u", b'{"event_id":"e","timestamp":"2024-02-14T15:50:34","page":"home"}', "t", 0, 5, None, 0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int",
    )
    out = to_console_rows(rec)
    assert out.columns == EVENT_COLUMNS + ["topic", "partition", "offset", "kafka_timestamp", "event_timestamp"]
    assert out.first().event_timestamp is not None


def test_uncommitted_batch_is_replayed_exactly_once(spark, sf_small):
    """A micro-batch that fails after it was planned (offset log written, no
    commit) is replayed on restart; the file sink shows every record once."""
    import pytest

    from strata.plans import fixtures
    from strata.schema import KAFKA_SOURCE_SCHEMA
    from strata.sources import files

    k = fixtures.kafka_fixture(spark, sf_small)
    src, out, ckpt = (scratch_path(spark, n) for n in ("t-src", "t-out", "t-ckpt"))
    import time

    cut1, cut2 = k.approxQuantile("offset", [1 / 3, 2 / 3], 0.0)
    parts = [F.col("offset") < cut1, (F.col("offset") >= cut1) & (F.col("offset") < cut2), F.col("offset") >= cut2]
    for cond in parts:  # one file per append, in arrival order
        k.filter(cond).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    poison = k.agg(F.max("offset")).first()[0]  # in the last file / batch
    stream = files.bronze_file_stream(spark, src, KAFKA_SOURCE_SCHEMA, max_files_per_trigger=1)
    failing = stream.withColumn(
        "value", F.when(F.col("offset") == poison, F.raise_error(F.lit("poisoned record"))).otherwise(F.col("value"))
    )
    q = jobs.start_bronze_stream(failing, out, ckpt, partition_col="event_month", available_now=True)
    with pytest.raises(Exception):
        q.awaitTermination()
    assert q.exception() is not None
    committed_before = spark.read.parquet(out).count()
    assert 0 < committed_before < k.count()

    q = jobs.start_bronze_stream(stream, out, ckpt, partition_col="event_month", available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    back = spark.read.parquet(out).select("offset", "partition", "kafka_timestamp")
    sent = k.select("offset", "partition", F.col("timestamp").alias("kafka_timestamp"))
    assert back.count() == sent.count()
    assert back.exceptAll(sent).count() == 0 and sent.exceptAll(back).count() == 0


def test_a_hot_day_is_written_by_several_tasks(spark, sf_small):
    """A batch of one day: as many files as its Kafka partitions and offset runs, and no row lost."""
    import glob

    from strata.plans.fixtures import kafka_fixture
    from strata.schema import KAFKA_SOURCE_SCHEMA
    from strata.session import local_path

    k = kafka_fixture(spark, sf_small)
    one_day = F.regexp_replace(F.col("value").cast("string"), '"event_date":"[^"]*"', '"event_date":"2024-05-01"').cast("binary")
    src, out, ckpt = (scratch_path(spark, n) for n in ("t-day-src", "t-day", "t-day-ckpt"))
    k = k.withColumn("value", one_day).where(F.col("value").cast("string").contains('"event_date"')).select(*KAFKA_SOURCE_SCHEMA.fieldNames())
    k.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(KAFKA_SOURCE_SCHEMA).parquet(src)
    # So few rows would be merged into one task; a batch beyond the advisory size is not.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        q = jobs.start_bronze_stream(stream, out, ckpt, available_now=True, rows_per_file=100)
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert q.exception() is None
    assert len(glob.glob(f"{local_path(out)}/event_date_parsed=2024-05-01/*.parquet")) > 1
    assert spark.read.parquet(out).count() == k.count()


def test_watermark_progression(spark, sf_small):
    """Watermark starts at 0 and then trails the maximum event time seen by
    10 minutes; with no stateful operator nothing is dropped."""
    import datetime as dt
    import time

    from strata.plans.fixtures import read_table

    ev = read_table(spark, sf_small, "events").select("event_id", F.col("ts").cast("timestamp").alias("event_timestamp"))
    src = scratch_path(spark, "t-wm-src")
    cut = ev.approxQuantile("event_id", [0.5], 0.0)[0]
    for cond in (F.col("event_id") < cut, F.col("event_id") >= cut):
        ev.filter(cond).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", "1").parquet(src)
    q = jobs.start_console_stream(jobs.with_event_watermark(stream), scratch_path(spark, "t-wm-ckpt"), fmt="memory",
                                  query_name="strata_wm", available_now=True)
    q.awaitTermination()
    marks = [p["eventTime"].get("watermark") for p in q.recentProgress if p.get("eventTime")]
    assert marks[0] == "1970-01-01T00:00:00.000Z"
    first_max = ev.filter(F.col("event_id") < cut).agg(F.max("event_timestamp")).first()[0]
    expected = (first_max - dt.timedelta(minutes=10)).strftime("%Y-%m-%dT%H:%M:%S")
    assert marks[1].startswith(expected)
    assert spark.table("strata_wm").count() == ev.count()


def _parquet_bytes(*folders):
    from pathlib import Path

    from strata.session import local_path

    return sum(f.stat().st_size for x in folders for f in Path(local_path(x)).rglob("*.parquet"))


def test_silver_log_survives_a_crash_and_a_replay(spark, sf_small):
    """A batch that fails half-way loses nothing that is stored; a replay of a committed batch adds nothing."""
    from strata.operators import silver
    from strata.plans.fixtures import bronze_fixture
    from strata.streaming import silver_log

    b = bronze_fixture(spark, sf_small).cache()
    log = scratch_path(spark, "test-silver-log")
    first, second = b.filter("partition < 2"), b.filter("partition >= 2")
    assert jobs.resolve_silver(spark, log).count() == 0
    jobs.append_silver_batch(first, 0, log)
    size = lambda n: _parquet_bytes(f"{log}/runs/batch-{n:010d}")
    stored = size(0)

    broken = second.withColumn("search_query", F.when(F.col("offset") % 50 == 0, F.raise_error(F.lit("crash"))).otherwise(F.col("search_query")))
    try:
        jobs.append_silver_batch(broken, 1, log)
        raise AssertionError("the write should have failed")
    except Exception as exc:  # noqa: BLE001
        assert "crash" in str(exc)
    assert size(0) == stored and jobs.resolve_silver(spark, log).count() == silver.silver_events(first).count()

    # The replay of batch 1, once more, and the second batch again under a new number.
    assert [jobs.append_silver_batch(second, number, log) for number in (1, 1, 2)] == [True, False, True]
    want = sorted(map(str, silver.silver_events(b).collect()))
    assert sorted(map(str, jobs.resolve_silver(spark, log).collect())) == want
    # A small batch writes little, however large the log is.
    jobs.append_silver_batch(second.limit(10), 3, log)
    assert size(0) == stored and size(3) < 0.2 * stored

    # Merged, the live runs hold one row per id, whatever the number of batches; the rest goes with the vacuum.
    assert silver_log.merge(spark, log, fan=3) == 1 and silver_log.merge(spark, log, fan=3) == 0
    (run,) = silver_log.live(spark, log)
    assert run.level == 1 and run.rows == len(want) and len(run.replaces) == 4
    assert sorted(map(str, jobs.resolve_silver(spark, log).collect())) == want
    assert len(silver_log.vacuum(spark, log, keep_seconds=3600)) == 0
    assert len(silver_log.vacuum(spark, log, keep_seconds=0)) == 4 and size(0) == 0
    assert sorted(map(str, jobs.resolve_silver(spark, log).collect())) == want
    b.unpersist()


def test_bytes_of_a_much_replayed_log_follow_its_ids(spark, sf_small):
    from strata.plans.fixtures import bronze_fixture
    from strata.streaming import silver_log

    b = bronze_fixture(spark, sf_small).limit(500).cache()
    log = scratch_path(spark, "test-silver-log")
    for number in range(9):
        jobs.append_silver_batch(b, number, log, query="again")
        silver_log.merge(spark, log, fan=3)
    found = silver_log.live(spark, log)
    ids = jobs.resolve_silver(spark, log).count()
    assert [r.level for r in found] == [2] and found[0].rows == ids
    b.unpersist()


def test_state_of_the_latest_rows_is_bounded_by_the_watermark(spark):
    """One row per id and minute; state leaves with the watermark, late rows are dropped and counted."""
    import time

    from strata.schema import BRONZE_SCHEMA
    from strata.streaming import silver_log

    src, log, ckpt = (scratch_path(spark, n) for n in ("t-latest-src", "t-latest-log", "t-latest-ckpt"))
    fixed = {"user_id": "'u'", "session_id": "'s'", "event_type": "'view'", "product_id": "'p'", "partition": "0"}

    def arrive(rows):
        df = spark.createDataFrame(rows, "event_id string, minute int, offset bigint, device string")
        time_of = F.expr("TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, minute)")
        full = df.withColumn("event_timestamp", time_of).withColumns({k: F.expr(v) for k, v in fixed.items()})
        full.select(*[F.col(f.name).cast(f.dataType) if f.name in full.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMA.fields]).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)

    for step in range(6):  # half an hour each; every id comes three times, the last one counts
        arrive([(f"e{step}-{i}", 30 * step + i % 5, 3 * i + again, f"d{again}") for i in range(40) for again in range(3)])
    arrive([("late", 0, 1, "x"), ("e5-1", 151, 999, "last")])
    stream = spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", "1").parquet(src)
    q = jobs.start_latest_stream(stream, log, ckpt, delay="10 minutes", span="1 minute", available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    state = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert max(s["numRowsTotal"] for s in state) <= 80 and sum(s["numRowsDroppedByWatermark"] for s in state) == 1
    assert "rocksdbCommitCheckpointLatency" in state[0]["customMetrics"] or any("rocksdb" in k for k in state[0]["customMetrics"])
    got = {r["event_id"]: r["device"] for r in jobs.resolve_silver(spark, log).collect()}
    assert got == {f"e{s}-{i}": "d2" for s in range(6) for i in range(40)} | {"e5-1": "last"}
    assert sum(r.rows for r in silver_log.live(spark, log)) <= 241


def test_watermark_of_two_inputs_follows_the_slower_one(spark):
    def source(name, minutes):
        src = scratch_path(spark, name)
        for m in minutes:
            spark.sql(f"SELECT {m} AS minute, TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, {m}) AS event_timestamp").coalesce(1).write.mode("append").parquet(src)
        return spark.readStream.schema("minute int, event_timestamp timestamp").option("maxFilesPerTrigger", "1").parquet(src)

    both = jobs.union_watermarked([source("t-fast", [600, 601]), source("t-slow", [45, 45])])
    ckpt = scratch_path(spark, "t-two-ckpt")
    q = jobs.start_console_stream(both, ckpt, fmt="memory", query_name="strata_two", available_now=True)
    q.awaitTermination()
    marks = [p["eventTime"].get("watermark") for p in q.recentProgress if p.get("eventTime")]
    assert spark.table("strata_two").count() == 4
    assert marks[-1] == "2024-01-01T00:35:00.000Z"
