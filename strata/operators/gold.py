"""Silver → the four Gold tables.

Every function is a pure aggregation of the Silver DataFrame. The plans use
partial (map-side) aggregation; several COUNT DISTINCTs are rewritten by
Catalyst into one `Expand` whose first shuffle is keyed by (group, value), so a
hot group key (one date with a third of all rows) is spread over many tasks
and only one pre-aggregated row per map task reaches the final group.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import money_avg, money_sum, pct

# The funnel vocabulary of the reference's conversion table.
VIEW_TYPES = ("view",)
CART_TYPES = ("add_to_cart",)
REMOVE_TYPES = ("remove_from_cart",)
PURCHASE_TYPES = ("purchase", "order", "checkout", "complete_purchase")


def _int_sum(c: str) -> Column:
    return F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint")


def _quantity_sums() -> list[Column]:
    return [
        _int_sum("quantity").alias("total_quantity"),
        _int_sum("removed_quantity").alias("total_removed_quantity"),
        _int_sum("net_quantity").alias("total_net_quantity"),
    ]


def daily_sales(silver: DataFrame) -> DataFrame:
    """G1: one row per event_date.

    Planned as two aggregations joined on the date: the regular sums and means
    shuffle one partial row per date and task, and the Expand of the three distinct
    counts runs over four narrow columns, without the regular buffers riding along.
    """
    dated = silver.filter(F.col("event_date").isNotNull())
    regular = dated.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("total_events"),
        money_sum("sales").alias("total_sales"),
        *_quantity_sums(),
        money_sum("discount_amount").alias("total_discount_amount"),
        money_avg("sales").alias("average_event_sales"),
        money_avg("discount_percent").alias("average_discount_percent"),
    )
    distinct = dated.groupBy("event_date").agg(
        F.countDistinct("user_id").alias("unique_customers"),
        F.countDistinct("session_id").alias("unique_sessions"),
        F.countDistinct("product_id").alias("unique_products"),
    )
    return regular.join(distinct, "event_date").select(
        "event_date",
        "total_events",
        "unique_customers",
        "unique_sessions",
        "unique_products",
        "total_sales",
        "total_quantity",
        "total_removed_quantity",
        "total_net_quantity",
        "total_discount_amount",
        "average_event_sales",
        "average_discount_percent",
    )


PRODUCT_KEY = ["product_id", "product_name", "category", "sub_category"]


def product_performance(silver: DataFrame) -> DataFrame:
    """One row per (product_id, product_name, category, sub_category).

    Planned as two aggregations joined on the group key: the regular sums and
    means shuffle only one partial row per key and task, and the two distinct
    counts run their Expand over narrow rows, without the regular aggregates'
    buffers riding along. The four-column key travels as one struct (struct
    equality treats NULL fields as equal, like GROUP BY), so both sides are
    partitioned alike and the join adds no shuffle.
    """
    keyed = silver.filter(F.col("product_id").isNotNull()).withColumn("_key", F.struct(*PRODUCT_KEY))
    regular = keyed.groupBy("_key").agg(
        F.count(F.lit(1)).alias("total_events"),
        *_quantity_sums(),
        money_sum("sales").alias("total_sales"),
        money_sum("discount_amount").alias("total_discount_amount"),
        money_avg("product_price").alias("average_product_price"),
        money_avg("discount_percent").alias("average_discount_percent"),
    )
    distinct = keyed.groupBy("_key").agg(
        F.countDistinct("user_id").alias("unique_customers"),
        F.countDistinct("session_id").alias("unique_sessions"),
    )
    return regular.join(distinct, "_key").select(
        *[F.col(f"_key.{k}").alias(k) for k in PRODUCT_KEY],
        "total_events",
        "unique_customers",
        "unique_sessions",
        "total_quantity",
        "total_removed_quantity",
        "total_net_quantity",
        "total_sales",
        "total_discount_amount",
        "average_product_price",
        "average_discount_percent",
    )


CUSTOMER_TEXT = ["customer_name", "segment", "country", "market", "region"]


def customer_activity(silver: DataFrame) -> DataFrame:
    """One row per user_id; descriptive columns are per-column MAX (they
    may come from different events, as in the reference).

    Planned as four aggregations joined on the user. Sums, counts and times have
    fixed-width buffers and shuffle one partial row per user and task. The two
    distinct counts each shuffle their own pairs of ids, without an Expand that
    triples the rows and carries the other buffers along. MAX of a string has no
    fixed-width buffer and is sort-based, so the events are first counted per user and
    texts, hash-aggregated; only those few rows are sorted, not every event. (The count
    is what keeps that step: Catalyst drops a plain DISTINCT below a MAX.)
    """
    users = silver.filter(F.col("user_id").isNotNull())
    texts = users.groupBy("user_id", *CUSTOMER_TEXT).agg(F.count(F.lit(1)).alias("_events"))
    text = texts.groupBy("user_id").agg(*[F.max(c).alias(c) for c in CUSTOMER_TEXT], F.sum("_events").cast("bigint").alias("total_events"))
    nums = users.groupBy("user_id").agg(
        *_quantity_sums(),
        money_sum("sales").alias("total_sales"),
        money_sum("discount_amount").alias("total_discount_amount"),
        F.min("event_timestamp").alias("first_activity"),
        F.max("event_timestamp").alias("last_activity"),
    )
    out = text.join(nums, "user_id")
    for column, name in (("session_id", "total_sessions"), ("product_id", "unique_products_viewed")):
        pairs = users.select("user_id", column).distinct()
        out = out.join(pairs.groupBy("user_id").agg(F.count(column).alias(name)), "user_id")
    return out.select(
        "user_id",
        *CUSTOMER_TEXT,
        "total_events",
        "total_sessions",
        "unique_products_viewed",
        "total_quantity",
        "total_removed_quantity",
        "total_net_quantity",
        "total_sales",
        "total_discount_amount",
        "first_activity",
        "last_activity",
    )


def _flag(types: Iterable[str]) -> Column:
    return F.max(F.when(F.col("event_type").isin(*types), F.lit(1)).otherwise(F.lit(0)))


def session_flags(
    silver: DataFrame,
    view_types: Iterable[str] = VIEW_TYPES,
    cart_types: Iterable[str] = CART_TYPES,
    remove_types: Iterable[str] = REMOVE_TYPES,
    purchase_types: Iterable[str] = PURCHASE_TYPES,
) -> DataFrame:
    """A1: per session, 1 if any event of the stage's vocabulary occurred."""
    return (
        silver.filter(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            _flag(view_types).alias("has_view"),
            _flag(cart_types).alias("has_add_to_cart"),
            _flag(remove_types).alias("has_remove_from_cart"),
            _flag(purchase_types).alias("has_purchase"),
        )
    )


def conversion_metrics(silver: DataFrame, **vocabulary: Iterable[str]) -> DataFrame:
    """Session flags → totals → four independent rates (one row).

    Rates are plain ratios guarded against a zero denominator, not an ordered
    funnel, so they can exceed 100.
    """
    totals = session_flags(silver, **vocabulary).agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.sum("has_view").cast("bigint").alias("view_sessions"),
        F.sum("has_add_to_cart").cast("bigint").alias("add_to_cart_sessions"),
        F.sum("has_remove_from_cart").cast("bigint").alias("remove_from_cart_sessions"),
        F.sum("has_purchase").cast("bigint").alias("purchase_sessions"),
    )
    return totals.select(
        "total_sessions",
        "view_sessions",
        "add_to_cart_sessions",
        "remove_from_cart_sessions",
        "purchase_sessions",
        pct("view_sessions", "total_sessions").alias("view_rate_percent"),
        pct("add_to_cart_sessions", "view_sessions").alias("add_to_cart_rate_percent"),
        pct("purchase_sessions", "add_to_cart_sessions").alias("cart_to_purchase_rate_percent"),
        pct("purchase_sessions", "total_sessions").alias("overall_conversion_rate_percent"),
    )


GOLD_TABLES = {
    "gold_daily_sales": daily_sales,
    "gold_product_performance": product_performance,
    "gold_customer_activity": customer_activity,
    "gold_conversion_metrics": conversion_metrics,
}
