"""Silver on increments, and distinct counts from daily bitmaps."""

import pytest
from pyspark.sql import functions as F

from strata.operators import distinct, increment, report, silver
from strata.plans.fixtures import bronze_fixture, bronze_with_extremes
from strata.session import scratch_path
from strata.sources import sinks


@pytest.fixture(scope="module")
def bronze(spark, sf_small):
    return sinks.stage(bronze_fixture(spark, sf_small), scratch_path(spark, "t-bronze"))


@pytest.mark.parametrize("broadcast_ids", [increment.BROADCAST_IDS, 0])
def test_refresh_equals_the_full_one(spark, bronze, broadcast_ids):
    history, new = (sinks.stage(silver.silver_events(bronze.filter(c)), scratch_path(spark, "t-part")) for c in ("partition < 3", "partition = 3 OR offset % 5 = 0"))
    got = increment.refresh_silver(history, new, broadcast_ids)
    want = silver.silver_events(bronze)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    empty = increment.refresh_silver(history, new.limit(0), broadcast_ids)
    assert sorted(map(str, empty.collect())) == sorted(map(str, history.collect()))


def test_many_new_ids_leave_null_and_repeated_ids_of_history_alone(spark, bronze):
    """Both ways agree on the ids of a history that is no plain Silver; the shuffle keeps its null ids."""
    s = silver.silver_events(bronze.limit(60))
    history = s.unionByName(s).unionByName(s.limit(5).withColumn("event_id", F.lit(None).cast("string")))
    new = s.limit(20).withColumn("offset", F.col("offset") + 1).unionByName(s.limit(2).withColumn("event_id", F.lit(None).cast("string")))
    history, new = sinks.stage(history, scratch_path(spark, "t-history")), sinks.stage(new, scratch_path(spark, "t-new"))
    ways = [sorted(r["event_id"] or "" for r in increment.refresh_silver(history, new, limit).collect()) for limit in (increment.BROADCAST_IDS, 0)]
    assert [e for e in ways[0] if e] == [e for e in ways[1] if e] and ways[1].count("") == 6
    assert len(ways[1]) > len(set(ways[1])) + 5


def test_rows_shuffled_follow_the_increment(spark):
    """Of a long history only rows with a new id, and few others, leave the direct way."""
    history = spark.range(200_000).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"))
    ids = spark.range(0, 400_000, 400).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"))
    kept, hit = increment.possibly_superseded(history, ids, 1000)
    assert hit.join(ids, "event_id").count() == 500 and kept.join(ids, "event_id").count() == 0
    assert 500 <= hit.count() <= 500 + 0.005 * 200_000 and kept.count() + hit.count() == 200_000


def test_daily_rows_give_the_executive_totals(spark, bronze, sf_small):
    s = sinks.stage(silver.silver_events(bronze), scratch_path(spark, "t-silver"))
    base = scratch_path(spark, "t-days")
    old, new = s.where("event_id < '3'"), s.where("event_id >= '3' OR event_id IS NULL")
    first = distinct.extend_dictionary(None, old, f"{base}/a")
    both = first.unionByName(distinct.extend_dictionary(first, new, f"{base}/b"))
    per = both.groupBy("id_column").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("no").alias("d"), F.countDistinct("id").alias("ids"), F.min("no").alias("lo"), F.max("no").alias("hi")).collect()
    assert {(r["n"], r["n"], r["n"], 1, r["n"]) for r in per} == {(r["n"], r["d"], r["ids"], r["lo"], r["hi"]) for r in per}
    # Both parts hold rows of the same days: their bitmaps are joined, not added.
    bits = distinct.daily_bitmaps(old, both).unionByName(distinct.daily_bitmaps(new, both))
    days = distinct.daily_amounts(old).unionByName(distinct.daily_amounts(new))
    assert [tuple(r) for r in distinct.executive_from_days(bits, days).collect()] == [tuple(r) for r in report.executive_totals(s).collect()]
    none = s.limit(0)
    empty = distinct.executive_from_days(distinct.daily_bitmaps(none, first), distinct.daily_amounts(none)).first()
    assert empty["total_customers"] == 0


def test_daily_rows_with_amounts_beyond_the_exact_range(spark, sf_small):
    s = sinks.stage(silver.silver_events(bronze_with_extremes(spark, sf_small)), scratch_path(spark, "t-silver"))
    numbers = distinct.extend_dictionary(None, s, scratch_path(spark, "t-dict"))
    assert distinct.executive_from_days(distinct.daily_bitmaps(s, numbers), distinct.daily_amounts(s)).first() == report.executive_totals(s).first()
