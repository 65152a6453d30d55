"""The golden Silver totals on the F1 fixture at sf0.001 (FIXTURES.md §2)."""

from pyspark.sql import functions as F

from strata.operators import gold, silver
from strata.plans.fixtures import bronze_fixture
from strata.functions import money_sum


def test_golden_totals(spark, sf_small):
    b = bronze_fixture(spark, sf_small)
    assert b.count() == 6000
    assert silver.keep_required(b).count() == 5763
    s = silver.silver_events(b).cache()
    r = s.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("session_id").alias("sessions"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("product_id").alias("products"),
        F.countDistinct("event_date").alias("dates"),
        F.count("product_price").alias("priced"),
        F.sum("quantity").alias("qty"),
        F.sum("net_quantity").alias("net"),
        money_sum("sales").alias("sales"),
        money_sum("discount_amount").alias("discount"),
    ).first()
    assert (r.rows, r.sessions, r.users, r.products, r.dates) == (4460, 1468, 150, 192, 2068)
    assert (r.priced, r.qty, r.net) == (4390, 91447, 88588)
    assert (r.sales, r.discount) == (223956751.26, 44960987.28)
    c = gold.conversion_metrics(s).first()
    assert (c.view_sessions, c.add_to_cart_sessions, c.remove_from_cart_sessions, c.purchase_sessions) == (533, 583, 528, 541)
    s.unpersist()
