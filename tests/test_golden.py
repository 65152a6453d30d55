"""Golden vectors: the README's worked examples and the FIXTURES F5/F6 cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import gold, silver
from strata.schema import BRONZE_SCHEMA


def bronze_rows(spark, rows):
    """Bronze rows from partial dicts (missing fields NULL, sensible ids)."""
    base = {
        "kafka_key": "k", "topic": "t", "partition": 0, "offset": 0,
        "kafka_timestamp": dt.datetime(2024, 2, 14, 15, 50, 34),
        "event_id": "e1", "user_id": "u1", "session_id": "s1", "event_type": "view",
        "timestamp": "2024-02-14T15:50:34", "event_date": "2024-02-14", "product_id": "p1",
        "event_timestamp": dt.datetime(2024, 2, 14, 15, 50, 34), "event_date_parsed": dt.date(2024, 2, 14),
    }
    full = []
    for r in rows:
        d = dict(base)
        d.update(r)
        full.append(tuple(d.get(f.name) for f in BRONZE_SCHEMA.fields))
    return spark.createDataFrame(full, BRONZE_SCHEMA)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_net_quantity_example(spark):
    r = one(silver.silver_events(bronze_rows(spark, [{"quantity": 2, "removed_quantity": 1}])))
    assert r.net_quantity == 1


def test_discount_amount_example(spark):
    r = one(silver.silver_events(bronze_rows(spark, [{"product_price": 389.57, "quantity": 2, "discount_percent": 25.0}])))
    assert r.discount_amount == 194.79


def test_sample_event(spark):
    r = one(silver.silver_events(bronze_rows(spark, [{
        "event_type": "remove_from_cart", "device": "tablet", "product_price": 389.57, "quantity": 2,
        "discount_percent": 25.0, "sales": 584.36, "removed_quantity": 2}])))
    assert (r.sales, r.net_quantity, r.event_date) == (584.36, 0, dt.date(2024, 2, 14))


@pytest.mark.parametrize(
    "inp, expect",
    [
        ({"quantity": None, "removed_quantity": 1}, {"quantity": None, "net_quantity": 0}),
        ({"quantity": 1, "removed_quantity": 3}, {"net_quantity": 0}),
        ({"product_price": -5.0, "quantity": 2, "discount_percent": 10.0}, {"product_price": None, "discount_amount": 0.0}),
        ({"discount_percent": 130.0}, {"discount_percent": 100.0}),
        ({"discount_percent": -20.0}, {"discount_percent": 0.0}),
        ({"quantity": -3, "removed_quantity": -1}, {"quantity": 0, "removed_quantity": 0, "net_quantity": 0}),
        ({"sales": -7.255}, {"sales": -7.26}),
        ({"event_type": " Add_To_Cart ", "event_id": " e1 "}, {"event_type": "add_to_cart", "event_id": "e1"}),
    ],
)
def test_clamp_and_derive(spark, inp, expect):
    r = one(silver.silver_events(bronze_rows(spark, [inp]))).asDict()
    for k, v in expect.items():
        assert r[k] == v, (k, r[k], v)


def test_dedup_latest_time_wins(spark):
    t1, t2 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11)
    r = one(silver.silver_events(bronze_rows(spark, [
        {"event_timestamp": t2, "offset": 1, "sales": 2.0}, {"event_timestamp": t1, "offset": 9, "sales": 1.0}])))
    assert r.sales == 2.0


def test_dedup_same_time_highest_offset(spark):
    r = one(silver.silver_events(bronze_rows(spark, [{"offset": 5, "sales": 5.0}, {"offset": 9, "sales": 9.0}])))
    assert r.offset == 9


def test_dedup_tie_on_offset_uses_partition(spark):
    r = one(silver.silver_events(bronze_rows(spark, [{"offset": 5, "partition": 0}, {"offset": 5, "partition": 3}])))
    assert r.partition == 3


def test_invalid_duplicate_never_shadows_valid(spark):
    t1, t2 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11)
    r = one(silver.silver_events(bronze_rows(spark, [
        {"event_timestamp": t1, "sales": 1.0}, {"event_timestamp": t2, "product_id": "  ", "sales": 2.0}])))
    assert r.sales == 1.0


def test_keep_rule_drops_blank_and_unparsed(spark):
    rows = [{"event_id": None}, {"event_id": "  "}, {"user_id": ""}, {"event_timestamp": None}, {"event_id": "ok"}]
    out = silver.silver_events(bronze_rows(spark, rows)).collect()
    assert [r.event_id for r in out] == ["ok"]


def test_date_fallback(spark):
    rows = [
        {"event_id": "a", "event_date_parsed": None, "event_date": "2024-03-01"},
        {"event_id": "b", "event_date_parsed": None, "event_date": "garbage", "event_timestamp": dt.datetime(2024, 4, 2, 5)},
    ]
    out = {r.event_id: r.event_date for r in silver.silver_events(bronze_rows(spark, rows)).collect()}
    assert out == {"a": dt.date(2024, 3, 1), "b": dt.date(2024, 4, 2)}


def sessions(spark, sets):
    rows = []
    n = 0
    for i, types in enumerate(sets):
        for t in types:
            n += 1
            rows.append({"event_id": f"e{n}", "session_id": f"s{i}", "event_type": t})
    return silver.silver_events(bronze_rows(spark, rows))


@pytest.mark.parametrize(
    "sets, expect",
    [
        ([{"view", "add_to_cart", "purchase"}, {"view", "add_to_cart"}, {"view"}, {"search"}],
         (4, 3, 2, 0, 1, 75.0, 66.67, 50.0, 25.0)),
        ([{"purchase"}], (1, 0, 0, 0, 1, 0.0, 0.0, 0.0, 100.0)),
        ([{"page_view"}, {"product_view"}], (2, 0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0)),
        ([{"view", "add_to_cart"}, {"add_to_cart"}], (2, 1, 2, 0, 0, 50.0, 200.0, 0.0, 0.0)),
    ],
)
def test_conversion_golden_sets(spark, sets, expect):
    assert tuple(one(gold.conversion_metrics(sessions(spark, sets)))) == expect


def test_conversion_custom_vocabulary(spark):
    df = sessions(spark, [{"page_view", "add_to_cart"}, {"product_view"}])
    r = one(gold.conversion_metrics(df, view_types=("page_view", "product_view")))
    assert (r.view_sessions, r.view_rate_percent, r.add_to_cart_rate_percent) == (2, 100.0, 50.0)


def test_conversion_empty_input(spark):
    empty = silver.silver_events(bronze_rows(spark, [{"event_id": None}]))
    r = one(gold.conversion_metrics(empty))
    assert r.total_sessions == 0 and r.view_sessions is None
    assert (r.view_rate_percent, r.overall_conversion_rate_percent) == (0.0, 0.0)
    assert r.add_to_cart_rate_percent is None and r.cart_to_purchase_rate_percent is None


def test_averages_count_nulls_as_zero(spark):
    df = silver.silver_events(bronze_rows(spark, [{"event_id": "a", "sales": 10.0}, {"event_id": "b", "sales": None}]))
    r = one(gold.daily_sales(df))
    assert (r.total_events, r.total_sales, r.average_event_sales) == (2, 10.0, 5.0)


def test_customer_max_mixes_rows(spark):
    df = silver.silver_events(bronze_rows(spark, [
        {"event_id": "a", "country": "B", "segment": "x"}, {"event_id": "b", "country": "A", "segment": "y"}]))
    r = one(gold.customer_activity(df))
    assert (r.country, r.segment) == ("B", "y")


def test_gold_totals_add_up(spark, sf_small):
    from strata.plans.fixtures import bronze_fixture

    s = silver.silver_events(bronze_fixture(spark, sf_small)).cache()
    n = s.count()
    sums = [one(fn(s).agg(F.sum("total_events"))).__getitem__(0) for fn in (gold.daily_sales, gold.product_performance, gold.customer_activity)]
    s.unpersist()
    assert sums == [n, n, n]


def test_nan_amounts_do_not_break_silver_or_gold(spark):
    df = silver.silver_events(bronze_rows(spark, [
        {"event_id": "a", "product_price": float("nan"), "quantity": 2, "discount_percent": float("nan"), "sales": float("nan")},
        {"event_id": "b", "sales": 3.0}]))
    a = {r.event_id: r for r in df.collect()}["a"]
    assert (a.product_price, a.discount_percent, a.sales, a.discount_amount) == (None, None, None, 0.0)
    assert one(gold.daily_sales(df)).total_sales == 3.0


def test_product_key_with_null_parts(spark):
    df = silver.silver_events(bronze_rows(spark, [
        {"event_id": "a", "product_id": "p1", "category": None, "user_id": "u1"},
        {"event_id": "b", "product_id": "p1", "category": None, "user_id": "u2"},
        {"event_id": "c", "product_id": "p1", "category": "X", "user_id": "u1"}]))
    got = {r.category: (r.total_events, r.unique_customers) for r in gold.product_performance(df).collect()}
    assert got == {None: (2, 2), "X": (1, 1)}
