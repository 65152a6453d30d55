"""Steps whose shuffled or stored bytes must follow the rows, not their printed form."""

import gzip
import os

from pyspark.sql import functions as F

from strata.operators import distinct, gold, increment
from strata.plans import catalog, fixtures, produce
from strata.schema import SILVER_SCHEMA
from strata.sources import sinks
from strata.streaming import silver_log


def _plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def _files(folder: str) -> list[str]:
    return [f for _, _, found in os.walk(folder) for f in found if f.startswith("part-")]


def test_compaction_settles_where_tasks_hold_several_months(spark, tmp_path):
    """many months to a task, months of one to several target files each."""
    spark.sql("CREATE TABLE settle_months (k BIGINT, text STRING, m STRING) USING parquet PARTITIONED BY (m) LOCATION '%s'" % (tmp_path / "t"))
    rows = spark.range(40_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"),
                                      F.when(F.col("id") % 3 == 0, "2024-01").when(F.col("id") % 97 != 0, F.concat(F.lit("m"), F.col("id") % 11)).alias("m"))
    try:
        for part in range(4):
            rows.where(F.pmod(F.xxhash64("k"), F.lit(4)) == part).repartition(3, "k").write.insertInto("settle_months")
        before = sorted(map(tuple, spark.table("settle_months").collect()), key=repr)
        target = 200_000
        assert sinks.compact_table(spark, "settle_months", "m", str(tmp_path / "c"), target)
        assert sinks.compact_table(spark, "settle_months", "m", str(tmp_path / "c"), target) == []
        after = {r["value"]: r["files"] for r in sinks.partition_files(spark, "settle_months", "m").collect()}
        assert after["2024-01"] > 1 and None in after
        assert sorted(map(tuple, spark.table("settle_months").collect()), key=repr) == before
    finally:
        spark.sql("DROP TABLE settle_months")


def test_line_numbers_run_on_over_the_files_of_a_log(spark, tmp_path):
    """a log per folder, in compressed files that follow each other by name."""
    for log, parts in {"a": [["{bad 1", "", "{}"], ["{bad 4"]], "b": [["{}"], ["", "{bad 3"]]}.items():
        (tmp_path / log).mkdir()
        for n, lines in enumerate(parts):
            with gzip.open(tmp_path / log / f"part-{n:05d}.txt.gz", "wt") as f:
                f.write("\n".join(lines) + "\n")
    paths = [str(tmp_path / log) for log in "ab"]
    _, bad = produce.prepare(spark, paths, one_log_per_folder=True)
    found = {(r["source_file"].split("/")[-2], r["line_number"]): r["json_line"] for r in bad.collect()}
    assert found == {("a", 1): "{bad 1", ("a", 3): "{}", ("a", 4): "{bad 4", ("b", 1): "{}", ("b", 3): "{bad 3"}
    _, bad = produce.prepare(spark, paths)
    assert sorted(r["line_number"] for r in bad.collect()) == [1, 1, 1, 2, 3]


def test_validation_logs_are_compressed_and_dealt_over_tasks(spark, sf_small, tmp_path):
    fixtures.write_validation_files(spark, sf_small, str(tmp_path / "v"))
    files = _files(str(tmp_path / "v"))
    assert len(files) > 4 and all(f.endswith(".gz") for f in files)


def test_json_lines_are_stored_compressed(spark, sf_small, monkeypatch, tmp_path):
    """F11"""
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: str(tmp_path / name))
    assert catalog.QUERIES["scan_jsonl"](spark, sf_small).count() == fixtures.event_rows(spark, sf_small).count()
    assert all(f.endswith(".gz") for f in _files(str(tmp_path / "events-jsonl")))


def test_json_is_made_after_the_rows_are_dealt(spark, sf_small):
    """Source rows cross the range shuffle, not their JSON."""
    rows = fixtures.kafka_fixture(spark, sf_small, fixtures.in_ranges(3, "kafka_timestamp", "offset", "partition"))
    lines = _plan(rows)
    dealt = next(i for i, line in enumerate(lines) if "rangepartitioning" in line)
    assert any("json" in line.lower() for line in lines[:dealt]) and not any("json" in line.lower() for line in lines[dealt:])
    plain = fixtures.kafka_fixture(spark, sf_small)
    assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()


def test_region_names_ride_along_in_no_shuffle(spark, sf_small):
    lines = _plan(fixtures.event_rows(spark, sf_small))
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(" in line]
    below = [line for i in exchanges for line in lines[i + 1:i + 3]]
    assert exchanges and not any("n_name" in line for line in below)


def test_a_merge_shuffles_once(spark):
    """F5"""
    rows = spark.createDataFrame([], silver_log.CANDIDATE_SCHEMA)
    assert sum("Exchange" in line for line in _plan(silver_log.merged(rows))) == 1


def test_bitmaps_are_made_where_they_stay(spark):
    """F16: 4 KB bitmaps are not shuffled, the numbers that make them are."""
    day = F.to_date(F.lit("2024-01-01"))
    s = spark.range(50).select(day.alias("event_date"), F.lit("view").alias("event_type"),
                               *[F.concat(F.lit(c), F.col("id") % 7).alias(c) for c in distinct.ID_COLUMNS])
    d = spark.createDataFrame([(c, f"{c}{i}", i + 1) for c in distinct.ID_COLUMNS for i in range(7)], "id_column string, id string, no bigint")
    bits = distinct.daily_bitmaps(s, d)
    lines = _plan(bits)
    made = [i for i, line in enumerate(lines) if "bitmap_construct_agg" in line]
    assert made and not any("Exchange" in line for line in lines[made[0]:made[-1]])
    assert {r["kind"]: r["ids"] for r in distinct.distinct_counts(bits, ["event_date"]).collect()} == {"customers": 7, "sessions": 7, "products": 7}


def test_the_fact_rows_of_the_star_join_are_not_sorted(spark, sf_small):
    """sorts of the widest rows held most of a task's memory."""
    lines = _plan(fixtures.event_rows(spark, sf_small))
    assert sum("ShuffledHashJoin [l_" in line for line in lines) == 2
    assert not any("Sort [l_" in line or "Sort [o_orderkey" in line or "Sort [p_" in line for line in lines)


def test_customer_activity_neither_expands_nor_sorts_events(spark):
    """ids are counted over their own pairs, and texts are made distinct before the MAX."""
    rows = [("u1", "s1", "p1", "Ann", "a"), ("u1", "s1", "p2", None, "b"), ("u1", None, "p2", "Bea", None), ("u2", None, None, None, None), (None, "s9", "p9", "x", "x")]
    s = spark.createDataFrame(rows, "user_id string, session_id string, product_id string, customer_name string, segment string").select(
        "*", *[F.lit("x").alias(c) for c in ("country", "market", "region")], *[F.lit(2).alias(c) for c in ("quantity", "removed_quantity", "net_quantity")],
        *[F.lit(1.5).alias(c) for c in ("sales", "discount_amount")], F.to_timestamp(F.lit("2024-01-01")).alias("event_timestamp"))
    out = gold.customer_activity(s)
    lines = _plan(out)
    assert not any("Expand" in line for line in lines)
    # Every sort-based MAX stands on the distinct texts: a partial one has a hash aggregation below it.
    assert all(any("HashAggregate" in below for below in lines[i + 1:i + 5]) for i, line in enumerate(lines) if "partial_max(customer_name" in line)
    got = {r["user_id"]: (r["customer_name"], r["segment"], r["total_events"], r["total_sessions"], r["unique_products_viewed"], r["total_sales"]) for r in out.collect()}
    assert got == {"u1": ("Bea", "b", 3, 1, 2, 4.5), "u2": (None, None, 1, 0, 0, 1.5)}


def test_many_new_ids_meet_history_in_one_shuffle(spark):
    """above the size of the bit table."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        empty = spark.createDataFrame([], SILVER_SCHEMA)
        lines = _plan(increment.refresh_silver(empty, spark.createDataFrame([tuple([None] * len(SILVER_SCHEMA))], SILVER_SCHEMA), 0))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum("Exchange" in line for line in lines) == 1
