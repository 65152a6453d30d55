"""Benchmark the headline queries; prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default:
all cores), BENCH_REPS (default 3; median after one warm-up).

Layered timings follow how the layers run in production: the Bronze rows
are stored once (setup, not timed), `silver_events` is timed from the Bronze
Parquet, Silver is stored, and each Gold table is timed over the stored
Silver. `batch_job_bronze_to_gold` runs the whole batch job with its
writes (Bronze table, Silver, four Gold tables, guards and reconciliation).
`stream_bronze_10_batches` streams the 100,000-row events table in ten
micro-batches into Bronze. The `e2e_*` entries time registered driver queries end to end from the
raw test tables (star join + Silver + Gold in one plan). Each query is run to
completion with the `noop` sink (full execution, nothing collected). If any
query fails the value is null and the exit code is not zero. `control_sec` times
a query outside this project's code beside every run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from strata.operators import gold, quality, silver  # noqa: E402
from strata.operators.bronze import kafka_to_bronze  # noqa: E402
from strata.plans import batch_job, catalog, fixtures  # noqa: E402
from strata.plans.fixtures import bronze_fixture  # noqa: E402
from strata.session import build_session  # noqa: E402
from strata.sources import files, layers  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
REPS = int(os.environ.get("BENCH_REPS", "3"))

E2E = ["gold_daily_sales", "gold_conversion_metrics", "validate_records", "bronze_parse_json", "dash_executive"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(make) -> float:
    run(make())  # warm-up
    times = []
    for _ in range(REPS):
        t0 = time.perf_counter()
        run(make())
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    spark = build_session(
        master=f"local[{CPUS}]",
        shuffle_partitions=max(2 * CPUS, 8),
        app="strata-bench",
        **{"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)},
    )
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-bench-ckpt-"))
    root = spark.sparkContext.getCheckpointDir().rstrip("/")
    bronze_path, silver_path = f"{root}/bench-bronze", f"{root}/bench-silver"
    results: dict[str, float | None] = {}
    errors: dict[str, str] = {}

    def record(name: str, measure) -> None:
        """One entry; a failure is recorded, never aborts the bench."""
        try:
            results[name] = measure()
        except Exception as exc:  # noqa: BLE001
            results[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"

    def repeated(action) -> float:
        times = []
        for i in range(REPS + 1):
            t0 = time.perf_counter()
            action()
            if i:
                times.append(time.perf_counter() - t0)
        return statistics.median(times)

    # A Bronze directory is many files (one per micro-batch task and day);
    # store the fixture as several files so the Silver scan is parallel.
    bronze_fixture(spark, SF_DIR).repartition(2 * CPUS).write.mode("overwrite").parquet(bronze_path)
    record("silver_events", lambda: timed(lambda: silver.silver_events(files.read_bronze_parquet(spark, bronze_path, nan_to_null=False))))
    silver.silver_events(files.read_bronze_parquet(spark, bronze_path, nan_to_null=False)).write.mode("overwrite").parquet(silver_path)
    stored = lambda: spark.read.parquet(silver_path)
    for key, fn in gold.GOLD_TABLES.items():
        record(key, lambda fn=fn: timed(lambda: fn(stored())))

    def from_raw_tables(key):
        layers.drop(spark)  # no stored layer of an earlier run: the whole path is timed
        return catalog.QUERIES[key](spark, SF_DIR)

    for key in E2E:
        record(f"e2e_{key}", lambda key=key: timed(lambda: from_raw_tables(key)))

    # The whole batch job: Bronze directory → Bronze table → Silver → 4 Gold
    # tables, each published (written) and read back by the next layer.
    warehouse = f"{root}/bench-warehouse"
    record("batch_job_bronze_to_gold", lambda: repeated(lambda: batch_job.run(spark, bronze_path, warehouse)))

    # The reference's example run: the events table (100,000 rows at sf0.1) as
    # a topic, consumed in 10 micro-batches into day-partitioned Bronze.
    def stream_runs() -> float:
        topic = catalog.stage_events_topic(spark, SF_DIR)
        return repeated(lambda: catalog.stream_topic_to_bronze(spark, topic))

    record("stream_bronze_10_batches", stream_runs)

    # Validator and parser on stored lines, without the fixture's join.
    lines_path, topic_path = f"{root}/bench-lines", f"{root}/bench-topic"
    fixtures.validation_lines(spark, SF_DIR).repartition(2 * CPUS).write.mode("overwrite").parquet(lines_path)
    fixtures.kafka_fixture(spark, SF_DIR).repartition(2 * CPUS).write.mode("overwrite").parquet(topic_path)
    record("stored_validate_records", lambda: timed(lambda: quality.validate(spark.read.parquet(lines_path))))
    record("stored_bronze_parse_json", lambda: timed(lambda: kafka_to_bronze(spark.read.parquet(topic_path))))
    # A query that no commit of this project touches: tells the machine's pace from the code's.
    control = timed(lambda: spark.read.parquet(f"{SF_DIR}/lineitem.parquet").groupBy("l_orderkey").agg(F.sum("l_extendedprice"), F.countDistinct("l_suppkey")))

    # A failure leaves no total: a missing entry must not look like a faster run.
    total = None if errors else sum(results.values())
    line = {
        "metric": "sum of median query times",
        "value": None if total is None else round(total, 3),
        "unit": "sec",
        "queries": {k: (round(v, 3) if v is not None else None) for k, v in results.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": CPUS,
        "reps": REPS,
        "control_sec": round(control, 3),
    }
    if errors:
        line["errors"] = errors
    print(json.dumps(line))
    spark.stop()
    if errors:
        sys.exit(1)


if __name__ == "__main__":
    main()
