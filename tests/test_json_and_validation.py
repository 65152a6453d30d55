"""F3 JSON parsing vectors and F4 record-validation vectors."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from strata.operators import bronze, quality
from strata.sources import kafka

SMALL = StructType([StructField("event_id", StringType()), StructField("quantity", IntegerType()), StructField("price", DoubleType())])


def parse(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "json_value string")
    return bronze.parse_events(df, SMALL).collect()


def test_parse_vectors(spark):
    rows = parse(spark, [
        '{"event_id":"a","quantity":2,"price":1.5}',
        "not json",
        '[{"event_id":"z"}]',
        '{"event_id":"a","quantity":"x","price":1}',
        '{"event_id":"a","quantity":2.0}',
        '{"event_id":5}',
        '{"event_id":"a","page":"home"}',
    ])
    assert tuple(rows[0]) == ("a", 2, 1.5)
    assert tuple(rows[1]) == (None, None, None)
    assert tuple(rows[2]) == (None, None, None)
    assert tuple(rows[3]) == ("a", None, 1.0)
    assert (rows[4].event_id, rows[4].quantity) == ("a", None)
    assert rows[5].event_id == "5"
    assert tuple(rows[6]) == ("a", None, None)


def test_empty_and_null_values_give_null_struct(spark):
    df = spark.createDataFrame([("",), (None,)], "json_value string")
    out = df.select(F.from_json("json_value", SMALL).alias("e")).collect()
    assert all(r.e is None for r in out)


def test_nan_then_null(spark):
    df = spark.createDataFrame([('{"event_id":"a","price":NaN}',)], "json_value string")
    parsed = bronze.parse_events(df, SMALL)
    assert math.isnan(parsed.first().price)
    assert bronze.doubles_nan_to_null(parsed).first().price is None


REQ = '"event_id":"e","user_id":"u","session_id":"s","event_type":"view","timestamp":"t","product_id":"p"'


@pytest.mark.parametrize(
    "line, valid, reason",
    [
        (None, False, "Input is not a string"),
        ("   ", False, "Empty line"),
        ("\t \n", False, "Empty line"),
        ("{bad", False, "Invalid JSON"),
        ("[1]", False, "JSON record is not an object"),
        ("3", False, "JSON record is not an object"),
        ('{"session_id":"s","event_type":"v","timestamp":"t","product_id":"p"}', False,
         "Missing required fields: event_id, user_id"),
        ("{" + REQ.replace('"session_id":"s"', '"session_id":null') + "}", False, "Required field 'session_id' is null"),
        ("{" + REQ.replace('"user_id":"u"', '"user_id":"  "') + "}", False, "Required field 'user_id' is empty"),
        ("{" + REQ.replace('"user_id":"u"', '"user_id":"\\t"') + "}", False, "Required field 'user_id' is empty"),
        ("{" + REQ.replace('"user_id":"u"', '"user_id":0') + "}", True, ""),
        ("{" + REQ + ',"extra":1,"page":"home"}', True, ""),
        ("{" + REQ + "}  \t", True, ""),
        ("{" + REQ + "} trailing", False, "Invalid JSON"),
        ("{" + REQ + ',"price":NaN}', True, ""),
    ],
)
def test_validation_vectors(spark, line, valid, reason):
    df = spark.createDataFrame([(line,)], "json_line string")
    r = quality.validate(df).first()
    assert (r.is_valid, r.reason) == (valid, reason)


def test_reject_summary_counts(spark):
    lines = ["{" + REQ + "}", "{bad", "{bad", "   "]
    df = quality.validate(spark.createDataFrame([(x,) for x in lines], "json_line string"))
    got = {(r.status, r.reason): r.lines for r in quality.reject_summary(df).collect()}
    assert got == {("sent", ""): 1, ("invalid", "Invalid JSON"): 2, ("invalid", "Empty line"): 1}
    ok, bad = quality.split_valid(df)
    assert (ok.count(), bad.count()) == (1, 3)


def test_kafka_encode_and_peek(spark):
    ev = spark.createDataFrame([("e1", "user_1", "view", None)], "event_id string, user_id string, event_type string, search_query string")
    rec = kafka.encode_events(ev, columns=["event_id", "user_id", "event_type", "search_query"])
    r = rec.first()
    assert bytes(r.key) == b"user_1"
    assert bytes(r.value).decode() == '{"event_id":"e1","user_id":"user_1","event_type":"view"}'
    peek_in = rec.select("value", F.lit(0).alias("partition"), F.lit(7).cast("long").alias("offset")).unionByName(
        spark.createDataFrame([(b"garbage", 0, 8)], "value binary, partition int, offset long")
    )
    out = {r.offset: r for r in kafka.peek(peek_in).collect()}
    assert (out[7].event_type, out[7].user_id, out[7].is_json) == ("view", "user_1", True)
    assert (out[8].event_type, out[8].is_json) == (None, False)


def test_kafka_options():
    o = kafka.kafka_options("broker:9092")
    assert o == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "ecommerce-events",
                 "startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "10000"}
    assert "maxOffsetsPerTrigger" not in kafka.kafka_options("b", max_offsets_per_trigger=None)


def test_wide_payload_fields(spark):
    from strata.operators import payload

    df = spark.createDataFrame(
        [('{"event_id":"e","page":"home","duration_seconds":12.5,"order_id":"o-1","cart_quantity":3}',)], "raw string"
    )
    r = payload.extract_payload(df, "raw").first()
    assert (r.page, r.duration_seconds, r.order_id, r.cart_quantity, r.failure_reason) == ("home", 12.5, "o-1", 3, None)
    wide = df.select(F.from_json("raw", payload.WIDE_EVENT_SCHEMA).alias("e")).select("e.*").first()
    assert (wide.event_id, wide.page) == ("e", "home")


def test_enrich_market_fills_missing(spark):
    ev = spark.createDataFrame([("Canada", None), ("India", "APAC"), ("Mars", None)], "country string, market string")
    lookup = spark.createDataFrame([("Canada", "Canada"), ("India", "APAC"), ("India", "APAC")], "country string, market string")
    rows = quality.enrich_market(ev, lookup).collect()
    assert len(rows) == 3  # a repeated lookup key never multiplies events
    assert {r.country: r.market for r in rows} == {"Canada": "Canada", "India": "APAC", "Mars": None}


def test_two_markets_for_a_country_are_an_error(spark):
    import pytest

    ev = spark.createDataFrame([("India", None)], "country string, market string")
    lookup = spark.createDataFrame([("India", "APAC"), ("India", "Asia")], "country string, market string")
    with pytest.raises(Exception, match="several markets for country India"):
        quality.enrich_market(ev, lookup).collect()


def test_missing_kafka_connector_is_reported(spark):
    import pytest

    with pytest.raises(kafka.KafkaConnectorMissing, match="spark-sql-kafka"):
        kafka.read_kafka_stream(spark, kafka.kafka_options("localhost:9092"))
    rec = kafka.encode_events(spark.createDataFrame([("e", "u")], "event_id string, user_id string"), columns=["event_id"])
    with pytest.raises(kafka.KafkaConnectorMissing):
        kafka.write_kafka(rec, "localhost:9092")
