"""Per-query shuffle bytes and Exchange counts from Spark's event log.

Usage: python tools/profile_queries.py [SF_DIR] [CPUS]

Runs the layered headline queries (as bench.py does) once each after a
warm-up, with the event log written to a fresh scratch folder, then sums the
shuffle bytes written by the tasks of each query's jobs and counts Exchange
nodes in each final (adaptive) plan. Prints one JSON object per query.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.operators import gold, silver  # noqa: E402
from strata.plans import catalog  # noqa: E402
from strata.plans.fixtures import bronze_fixture  # noqa: E402
from strata.session import build_session  # noqa: E402
from strata.sources import files  # noqa: E402


def read_lines(path: str):
    """Lines of a plain or zstd-compressed (rolling) event log file."""
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    scratch = tempfile.mkdtemp(prefix="run-")
    spark = build_session(
        master=f"local[{cpus}]", shuffle_partitions=2 * cpus, app="strata-profile",
        **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{scratch}", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setCheckpointDir(f"{scratch}/ckpt")
    bronze_path, silver_path = f"{scratch}/bronze", f"{scratch}/silver"
    bronze_fixture(spark, sf).repartition(2 * cpus).write.parquet(bronze_path)
    silver.silver_events(files.read_bronze_parquet(spark, bronze_path, nan_to_null=False)).write.parquet(silver_path)

    makers = {"silver_events": lambda: silver.silver_events(files.read_bronze_parquet(spark, bronze_path, nan_to_null=False))}
    for k, fn in gold.GOLD_TABLES.items():
        makers[k] = lambda fn=fn: fn(spark.read.parquet(silver_path))
    for k in ("gold_daily_sales", "validate_records", "bronze_parse_json"):
        makers[f"e2e_{k}"] = lambda k=k: catalog.QUERIES[k](spark, sf)

    exchanges, secs = {}, {}
    for name, make in makers.items():
        spark.sparkContext.setJobGroup("warmup", "warmup")
        make().write.format("noop").mode("overwrite").save()
        df = make()
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        secs[name] = time.perf_counter() - t0
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges[name] = plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition") + plan.count(
            "Exchange rangepartitioning") + plan.count("Exchange RoundRobinPartitioning")
    spark.sparkContext.setJobGroup("", "")
    spark.stop()

    job_group, stage_job = {}, {}
    shuffle = {}
    for path in sorted(glob.glob(f"{scratch}/eventlog*/events_*") + glob.glob(f"{scratch}/local-*")):
        for line in read_lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                job_group[ev["Job ID"]] = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
            elif kind == "SparkListenerTaskEnd":
                group = job_group.get(stage_job.get(ev.get("Stage ID")))
                if group in makers:
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    shuffle[group] = shuffle.get(group, 0) + int(m.get("Shuffle Bytes Written", 0))
    for name in makers:
        print(json.dumps({"query": name, "sec": round(secs[name], 3), "shuffle_bytes": shuffle.get(name, 0), "exchanges": exchanges[name]}))


if __name__ == "__main__":
    main()
