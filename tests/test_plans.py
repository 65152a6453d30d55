"""Plan-shape checks: one shuffle in Silver with a partial top-1 before it,
pushed filters, pruned scans, no Python UDF anywhere."""

import pytest

from strata.operators import gold, silver
from strata.plans import catalog
from strata.plans.fixtures import bronze_fixture
from strata.session import scratch_path
from strata.sources import files, layers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze_path(spark, sf_small):
    path = scratch_path(spark, "test-bronze")
    bronze_fixture(spark, sf_small).write.parquet(path)
    return path


def test_silver_single_exchange_with_partial_window_limit(spark, bronze_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(silver.silver_events(files.read_bronze_parquet(spark, bronze_path, nan_to_null=False)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange hashpartitioning") == 1
    assert p.count("WindowGroupLimit") == 2
    assert "PushedFilters: [IsNotNull(event_timestamp), IsNotNull(event_id)" in p


def test_gold_scan_is_pruned(spark, bronze_path):
    s = silver.silver_events(files.read_bronze_parquet(spark, bronze_path, nan_to_null=False))
    path = scratch_path(spark, "test-silver")
    s.write.parquet(path)
    g = gold.conversion_metrics(spark.read.parquet(path))
    p = plan(g)
    assert "ReadSchema: struct<session_id:string,event_type:string>" in p


def test_no_python_udf_in_any_plan(spark, sf_small):
    skip = {"scan_jsonl", "scan_bronze_parquet", "bronze_null_fill", "bronze_full_refresh", "reconcile_counts",
            "publish_table", "parquet_round_trip", "compact_bronze", "stream_bronze_append", "stream_restart",
            "stream_watermark", "stream_silver", "market_enrich"}
    for key, q in catalog.QUERIES.items():
        if key in skip:
            continue
        p = plan(q(spark, sf_small))
        assert "PythonUDF" not in p and "EvalPython" not in p and "FlatMapGroupsInPandas" not in p, key


def test_fan_out_queries_read_stored_layers(spark, sf_small):
    """Queries that branch Silver into several aggregations read it from
    storage; the star join is not recomputed per branch."""
    for key in ("gold_customer_activity", "gold_product_performance", "top_products", "dash_category_sales"):
        p = plan(catalog.QUERIES[key](spark, sf_small))
        assert "lineitem.parquet" not in p, key


def test_only_needed_columns_are_staged(spark, sf_small, monkeypatch):
    """No copy of Bronze for counts, and no Silver column that the query does not read."""
    staged = {}
    real = catalog.sinks.stage

    def recording(df, path):
        staged[key].append(df.columns)
        return real(df, path)

    monkeypatch.setattr(catalog.sinks, "stage", recording)
    for key in ("layer_counts", "verify_uniqueness", "event_type_counts", "silver_invariants", "gold_product_performance", "gold_customer_activity", "dash_geo_sales"):
        staged[key] = []
        layers.drop(spark)
        catalog.QUERIES[key](spark, sf_small)
    invariants = ["event_id", "discount_percent", "quantity", "removed_quantity", "net_quantity", "product_price"]
    assert staged == {
        "layer_counts": [catalog.GOLD_INPUT], "verify_uniqueness": [], "event_type_counts": [], "silver_invariants": [invariants],
        "gold_product_performance": [catalog.PRODUCT_INPUT], "gold_customer_activity": [catalog.CUSTOMER_INPUT], "dash_geo_sales": [catalog.CUSTOMER_INPUT],
    }
    assert len(catalog.PRODUCT_INPUT) == 13 and len(catalog.CUSTOMER_INPUT) <= 15
