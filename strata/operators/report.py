"""Verification and dashboard queries over the layers.

Counts and distinct counts are single global aggregations (partial per task,
one tiny final task). The dashboard roll-ups read the Gold tables, which are
orders of magnitude smaller than Silver; D1 reads Silver because distinct
counts do not add up across days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import money_sum, pct
from strata.operators.gold import PURCHASE_TYPES


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """A3: COUNT(*) per named layer/table → (layer, total_rows)."""
    parts = [df.agg(F.count(F.lit(1)).alias("total_rows")).select(F.lit(name).alias("layer"), "total_rows") for name, df in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def uniqueness(layers: dict[str, DataFrame], key: str = "event_id") -> DataFrame:
    """A4: COUNT(*) and COUNT(DISTINCT key) per layer."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct(key).alias("unique_events")).select(
            F.lit(name).alias("layer"), "total_rows", "unique_events"
        )
        for name, df in layers.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def event_type_counts(df: DataFrame) -> DataFrame:
    """A5: events per event_type, most frequent first."""
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count")).orderBy(
        F.col("event_count").desc(), F.col("event_type").asc_nulls_first()
    )


def event_type_counts_by_layer(layers: dict[str, DataFrame]) -> DataFrame:
    """A5 for several layers: ordered by layer, then most frequent first, as the last step."""
    parts = [df.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count")).select(F.lit(name).alias("layer"), "event_type", "event_count") for name, df in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("layer", F.col("event_count").desc(), F.col("event_type").asc_nulls_first())


def top_by_sales(gold_df: DataFrame, key: list[str], n: int | None = None) -> DataFrame:
    """O2: the whole Gold listing, highest total_sales first (ties by key): a range
    exchange and a sort. With `n` a top-k report, planned as
    TakeOrderedAndProject (per-task top-n, then merge)."""
    order = [F.col("total_sales").desc()] + [F.col(k).asc_nulls_last() for k in key]
    listing = gold_df.orderBy(*order)
    return listing if n is None else listing.limit(n)


def list_daily_sales(daily: DataFrame) -> DataFrame:
    """O2: all days with all columns, in date order."""
    return daily.orderBy("event_date")


def sample_rows(df: DataFrame, key: str = "event_id", n: int = 5) -> DataFrame:
    """O3: deterministic n-row sample (first by key)."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(n)


def executive_totals(silver: DataFrame, purchase_types=PURCHASE_TYPES) -> DataFrame:
    """Headline numbers in one aggregation over Silver."""
    purchase_session = F.when(F.col("event_type").isin(*purchase_types), F.col("session_id"))
    agg = silver.agg(
        money_sum("sales").alias("total_sales"),
        F.countDistinct("user_id").alias("total_customers"),
        F.countDistinct("session_id").alias("total_sessions"),
        F.sum(F.coalesce(F.col("quantity"), F.lit(0))).cast("bigint").alias("total_quantity"),
        F.countDistinct(purchase_session).alias("purchase_sessions"),
    )
    return agg.select(
        "total_sales",
        "total_customers",
        "total_sessions",
        "total_quantity",
        "purchase_sessions",
        pct("purchase_sessions", "total_sessions").alias("conversion_rate_percent"),
    )


def daily_trend(daily: DataFrame) -> DataFrame:
    """The daily sales table read in date order (for a trend chart)."""
    return daily.select("event_date", "total_sales", "total_events", "unique_customers", "total_net_quantity").orderBy("event_date")


def _rollup_money(c: str) -> Column:
    return money_sum(c)


def category_sales(products: DataFrame) -> DataFrame:
    """D3: product performance rolled up to (category, sub_category)."""
    return products.groupBy("category", "sub_category").agg(
        F.count(F.lit(1)).alias("products"),
        F.sum("total_events").cast("bigint").alias("total_events"),
        F.sum("total_quantity").cast("bigint").alias("total_quantity"),
        F.sum("total_net_quantity").cast("bigint").alias("total_net_quantity"),
        _rollup_money("total_sales").alias("total_sales"),
        _rollup_money("total_discount_amount").alias("total_discount_amount"),
    )


def segment_sales(customers: DataFrame) -> DataFrame:
    """Customer activity rolled up by segment."""
    return customers.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("total_events").cast("bigint").alias("total_events"),
        F.sum("total_sessions").cast("bigint").alias("total_sessions"),
        _rollup_money("total_sales").alias("total_sales"),
    )


def geo_sales(customers: DataFrame) -> DataFrame:
    """Customer activity rolled up by (country, market, region)."""
    return customers.groupBy("country", "market", "region").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("total_events").cast("bigint").alias("total_events"),
        _rollup_money("total_sales").alias("total_sales"),
    )


def funnel_stages(conversion: DataFrame) -> DataFrame:
    """The one-row conversion table unpivoted to (stage_order, stage, sessions, rate_percent)."""
    return conversion.select(
        F.expr(
            "stack(6, "
            "1, 'sessions', total_sessions, CAST(NULL AS DOUBLE), "
            "2, 'view', view_sessions, view_rate_percent, "
            "3, 'add_to_cart', add_to_cart_sessions, add_to_cart_rate_percent, "
            "4, 'remove_from_cart', remove_from_cart_sessions, CAST(NULL AS DOUBLE), "
            "5, 'purchase', purchase_sessions, cart_to_purchase_rate_percent, "
            "6, 'overall', purchase_sessions, overall_conversion_rate_percent"
            ") AS (stage_order, stage, sessions, rate_percent)"
        )
    )
