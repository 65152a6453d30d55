"""End-to-end jobs: producer (JSONL → validated records) and the batch job."""

import json

from pyspark.sql import functions as F

from strata.plans import batch_job, fixtures, produce
from strata.session import scratch_path
from strata.sources import files, sinks


def test_producer_counts(spark, sf_small):
    src = scratch_path(spark, "test-jsonl")
    ev = fixtures.event_rows(spark, sf_small)
    ev.select(fixtures.json_value().alias("value")).unionByName(
        spark.createDataFrame([("{bad",), ("   ",), ("[1]",)], "value string")
    ).unionByName(
        spark.createDataFrame([('{"event_id":"x1","user_id":"u9","session_id":"s","event_type":"view",'
                                '"timestamp":"t","product_id":"p","page":"home"}',)], "value string")
    ).write.text(src)
    out = scratch_path(spark, "test-produce")
    counts = produce.run(spark, src, out)
    expected_invalid = ev.filter(F.col("event_id").isNull() | (F.trim("event_id") == "")).count() + 2
    assert counts == {"sent": ev.count() - expected_invalid + 2 + 1, "invalid": expected_invalid}
    recs = spark.read.parquet(f"{out}/records")
    rec = recs.first()
    assert json.loads(bytes(rec.value))["user_id"] == bytes(rec.key).decode()
    extra = recs.filter(F.col("key") == F.lit(b"u9")).first()
    assert json.loads(bytes(extra.value))["page"] == "home"  # event-specific keys travel on


def test_batch_job_run(spark, sf_small):
    bronze_dir = scratch_path(spark, "test-bronze-dir")
    sinks.write_partitioned(sinks.with_month_partition(fixtures.bronze_fixture(spark, sf_small)), bronze_dir, "event_month")
    counts = batch_job.run(spark, bronze_dir, scratch_path(spark, "test-warehouse"))
    assert counts["bronze"] == 6000 and counts["silver"] == 4460
    assert counts["gold_daily_sales"] == 2068 and counts["gold_conversion_metrics"] == 1
    # rerun replaces, never duplicates
    again = batch_job.run(spark, bronze_dir, scratch_path(spark, "test-warehouse"))
    assert again == counts and spark.table("silver_events").count() == 4460
    reports = batch_job.verify(spark)
    layers = {r.layer: r.total_rows for r in reports["layer_counts"].collect()}
    assert layers["bronze"] == 6000 and layers["silver"] == 4460 and layers["gold_daily_sales"] == 2068
    uniq = {r.layer: (r.total_rows, r.unique_events) for r in reports["uniqueness"].collect()}
    assert uniq["silver"] == (4460, 4460)
    assert reports["silver_sample"].count() == 5


def test_producer_counts_every_line_and_loses_no_event(spark):
    """Joined or quoted lines are quarantined as a whole: no event vanishes uncounted."""
    one = '{"event_id":"%s","user_id":"u","session_id":"s","event_type":"view","timestamp":"t","product_id":"p"}'
    lines = [one % "e1", one % "e2" + one % "e3", one % "e4" + " " + one % "e5", one % "e6" + "}", one % "e7" + "," + one % "e8", (one % "e9").replace('"', "'"), "null", "NaN", one % "\\u001c"]
    src, out = scratch_path(spark, "test-joined"), scratch_path(spark, "test-joined-out")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(src)
    assert produce.run(spark, src, out) == {"sent": 1, "invalid": len(lines) - 1}
    sent = [json.loads(bytes(r["value"]))["event_id"] for r in spark.read.parquet(f"{out}/records").collect()]
    kept = {r["json_line"]: r["reason"] for r in spark.read.parquet(f"{out}/quarantine").collect()}
    assert sent == ["e1"] and set(kept) == set(lines[1:])
    assert [kept[x] for x in lines[1:6]] == ["Invalid JSON"] * 5 and kept["null"] == kept["NaN"] == "JSON record is not an object"
    assert kept[lines[8]] == "Required field 'event_id' is empty"


def test_quarantine_has_line_numbers_over_many_splits(spark, tmp_path):
    """Numbers are the lines' own, blank ones counted, however the files are split and ended."""
    good = '{"event_id":"e","user_id":"u","session_id":"s","event_type":"view","timestamp":"t","product_id":"p"}'
    want = set()
    for name, end in (("a.jsonl", "\n"), ("b.jsonl", "\r\n"), ("c.jsonl", "\n")):
        lines = [["", " 　\t", good, f"bad {name} {i}", "[1]"][(i * 7 + i // 11) % 5] for i in range(700)]
        (tmp_path / name).write_bytes(end.join(lines).encode() + (end.encode() if name == "a.jsonl" else b""))
        want |= {(name, i, line) for i, line in enumerate(lines, 1) if line.strip() and line != good}
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        assert files.scan_lines(spark, str(tmp_path)).select("source_file", "split_start").distinct().count() > 20
        records, quarantine = produce.prepare(spark, str(tmp_path))
        got = {(r["source_file"].rsplit("/", 1)[1], r["line_number"], r["json_line"]) for r in quarantine.collect()}
        assert got == want and quarantine.count() == len(want)
        assert records.count() == 3 * 700 - len(want) - sum(1 for i in range(700) if (i * 7 + i // 11) % 5 < 2) * 3
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
