"""Rows cross wide shuffles with their texts in one column, and leave no shuffle files behind."""

import os

import pytest
from pyspark.sql import functions as F

from strata.functions import strip_ws
from strata.functions.packing import with_packed_texts
from strata.operators import quality, silver
from strata.plans import catalog, fixtures
from strata.schema import BRONZE_SCHEMA, KAFKA_SOURCE_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA
from strata.session import DROP_SHUFFLES, scratch_path, settings
from strata.sources import sinks
from strata.streaming import jobs, silver_log


def _plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def _exchanged(df) -> list[str]:
    """The lines below each whole-row exchange."""
    lines = _plan(df)
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange" in line]


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_any_text_survives_the_packing(spark):
    odd = [None, "", " ", "\x01", "\x02", "a\x01b", "x\x02", "\\", '"', ",", "\n", "\r\n", "é\U0001f600", "\x00", "퟿"]
    rows = [(i, a, b, f"k{i}") for i, (a, b) in enumerate((a, b) for a in odd for b in odd)]
    df = spark.createDataFrame(rows, "n int, `a.b` string, c string, k string")
    broken = df.where("n < 3").select("n", F.lit(b"\xff\xfe").cast("string").alias("a.b"), F.lit(b"\xc3").cast("string").alias("c"), "k")
    df = df.unionByName(broken)
    seen = lambda d: _rows(d.select("n", F.hex(F.col("`a.b`").cast("binary")).alias("a"), F.hex(F.col("c").cast("binary")).alias("c"), "k"))
    out = with_packed_texts(df, lambda r: r.repartition(3, "k").withColumn("more", F.lit(1)), keep=("k",))
    assert out.columns == ["n", "a.b", "c", "k", "more"]
    assert seen(out) == seen(df)


def test_whole_rows_cross_the_shuffle_of_silver_packed(spark, sf_small):
    """F13, F14, F17"""
    bronze = fixtures.bronze_fixture(spark, sf_small)
    packed = silver.silver_events(bronze, SILVER_COLUMNS)
    assert packed.columns == SILVER_COLUMNS and packed.exceptAll(silver.silver_events(bronze)).isEmpty()
    assert packed.count() == silver.silver_events(bronze).count()
    for key in ("silver_events", "silver_sample"):
        lines = _plan(catalog.QUERIES[key](spark, sf_small))
        i = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(event_id" in line)
        assert any("_texts" in line for line in lines[i + 1:i + 5])
    some = ["product_id", "discount_amount", "category"]  # F15, F16: only what is asked for
    few = silver.silver_events(bronze, some)
    assert few.columns == some and _rows(few) == _rows(silver.silver_events(bronze).select(*some))
    assert not any("c_name" in line for line in _plan(few) if "lineitem" not in line)


def test_log_and_stream_rows_cross_their_shuffles_packed(spark):
    """F1, F2, F3, F6, F8"""
    empty = spark.createDataFrame([], silver_log.CANDIDATE_SCHEMA)
    assert any("_texts" in line for line in _exchanged(silver_log.merged(empty)) + _plan(silver_log.merged(empty)))
    stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(os.path.dirname(__file__))
    state = silver_log.latest_rows(stream)
    assert state.columns == silver_log.CANDIDATE_SCHEMA.fieldNames()
    assert "_texts" in state._jdf.queryExecution().analyzed().toString()


def test_a_write_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    """Files of finished writes held the disk until the driver's next garbage collection."""
    key = next(iter(DROP_SHUFFLES))
    seen = []
    df = spark.range(100).withColumn("day", F.lit("d")).withColumn("seen", F.lit(1)).repartition(3, "id")
    original = type(df.write).parquet
    monkeypatch.setattr(type(df.write), "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(key, None)), original(self, *a, **k))[1])
    before = spark.conf.get(key, None)
    sinks.stage(df, str(tmp_path / "a"))
    sinks.write_partitioned(df, str(tmp_path / "b"), "day")
    sinks.round_trip(df, str(tmp_path / "c"))
    silver_log.append(spark.createDataFrame([], silver_log.CANDIDATE_SCHEMA), 0, str(tmp_path / "log"))
    catalog._append_files(df, str(tmp_path / "d"))
    assert seen == ["true"] * 5 and spark.conf.get(key, None) == before
    with pytest.raises(ValueError), settings(spark, DROP_SHUFFLES):
        raise ValueError
    assert spark.conf.get(key, None) == before


def test_stream_shuffles_go_with_their_batch(spark, monkeypatch):
    """A stream keeps the settings that it is started with."""
    key, seen = next(iter(DROP_SHUFFLES)), []
    original = jobs.with_trigger
    monkeypatch.setattr(jobs, "with_trigger", lambda *a: (seen.append(spark.conf.get(key, None)), original(*a))[1])
    for start, schema in ((jobs.start_bronze_stream, KAFKA_SOURCE_SCHEMA), (jobs.start_silver_stream, BRONZE_SCHEMA), (jobs.start_latest_stream, BRONZE_SCHEMA)):
        src, out, ckpt = (scratch_path(spark, n) for n in ("t-drop-src", "t-drop", "t-drop-ckpt"))
        spark.createDataFrame([], schema).write.parquet(src)
        q = start(spark.readStream.schema(schema).parquet(src), out, ckpt, available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    assert seen == ["true"] * 3 and spark.conf.get(key, None) is None


def test_parts_need_no_shuffle_of_their_own(spark, sf_small):
    """The staged rows are dealt by the join's own shuffle, in exactly as many parts."""
    where = fixtures.source_column("partition") < 2
    dealt = fixtures.bronze_fixture(spark, sf_small, fixtures.InParts(3, where))
    plain = fixtures.bronze_fixture(spark, sf_small)
    exchanges = lambda df: sum("Exchange" in line and "Broadcast" not in line for line in _plan(df))
    assert exchanges(dealt) == exchanges(plain)
    assert dealt.rdd.getNumPartitions() == 3
    want = plain.where("partition < 2")
    assert dealt.count() == want.count() and dealt.exceptAll(want).isEmpty()


def test_slices_of_time_part_the_rows(spark, tmp_path):
    """Also rows without a time, equal times, and no rows."""
    times = [None, None, *["2024-01-01 00:00:00"] * 5, *[f"2024-02-{d:02d} 00:00:00" for d in range(1, 9)]]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "l_orderkey int, t string").select("l_orderkey", F.to_timestamp("t").alias("l_shipdate"))
    for name, df in (("some", rows), ("none", rows.limit(0)), ("null", rows.where("l_shipdate IS NULL"))):
        df.write.parquet(str(tmp_path / name / "lineitem.parquet"))
        conditions = fixtures.slices(spark, str(tmp_path / name), 3, F.col("l_shipdate"), F.col("l_orderkey") >= 1)
        got = [[r["l_orderkey"] for r in df.where(c).collect()] for c in conditions]
        assert sorted(x for part in got for x in part) == [r["l_orderkey"] for r in df.where("l_orderkey >= 1").orderBy("l_orderkey").collect()]
        if name == "some":
            assert len(got) == 3 and 1 in got[0] and max(got[0]) < min(got[1]) <= max(got[1]) < min(got[2])


def test_validation_prints_no_type_of_a_value(spark):
    """a look at the value tells a blank text; its type, printed as text, cost more than the parse."""
    df = spark.createDataFrame([(x,) for x in (
        '{"event_id":" ","user_id":"u","session_id":"s","event_type":"t","timestamp":"x","product_id":"p"}',
        '{"event_id":0,"user_id":false,"session_id":{},"event_type":[],"timestamp":{"a":" "},"product_id":1.5}',
        '{"event_id":[" "],"user_id":"u","session_id":"s","event_type":"","timestamp":"x","product_id":null}',
        '\t{"user_id":"u","session_id":"s","event_type":"t","timestamp":null,"product_id":"p"} \x1c', "{", "}", "{}", "", " { } x")], "json_line string")
    out = quality.validate(df)
    assert not any("schema_of_variant" in line or "SchemaOfVariant" in line for line in _plan(out))
    # The first failing field in sorted order counts.
    assert [r["reason"] for r in out.collect()][:4] == [
        "Required field 'event_id' is empty", "", "Required field 'event_type' is empty", "Missing required fields: event_id"]
    assert [r[0] for r in df.select(strip_ws("json_line")).collect()][3:] == [
        '{"user_id":"u","session_id":"s","event_type":"t","timestamp":null,"product_id":"p"}', "{", "}", "{}", "", "{ } x"]


def test_increment_and_schema_stay(spark, sf_small):
    """F10"""
    assert catalog.QUERIES["silver_incremental"](spark, sf_small).schema.names == SILVER_SCHEMA.names
