"""Bronze → Silver: keep-rule, standardise, clamp, deduplicate, derive.

The order is fixed because it changes results: filter on raw values →
trim/cast/round → clamp → dedup → derive. An invalid duplicate therefore never
shadows a valid one, and the derived amounts use clamped values.

Physical plan: one scan with pushed `IsNotNull` filters, projections fused into
one codegen stage, a partial `WindowGroupLimit` (top-1 per event_id inside each
map task) before the single shuffle on event_id, and the final top-1 after it.
A hot event_id therefore sends at most one row per map task over the network.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from strata.functions import in_exact_range, lower_trim, money_round, nan_to_null, not_blank
from strata.functions.packing import with_packed_texts
from strata.schema import LOWER_TRIM_COLUMNS, SILVER_COLUMNS, SILVER_REQUIRED, TRIM_COLUMNS


def keep_required(bronze: DataFrame) -> DataFrame:
    """Required ids present and not blank (SQL TRIM), event time parsed."""
    cond = F.col("event_timestamp").isNotNull()
    for c in SILVER_REQUIRED:
        cond = cond & not_blank(c)
    return bronze.filter(cond)


def resolved_event_date():
    """Parsed date, else the text cast to DATE, else the day of the event time."""
    return F.coalesce(
        F.col("event_date_parsed"),
        F.expr("try_cast(event_date AS DATE)"),
        F.to_date(F.col("event_timestamp")),
    )


def standardize(df: DataFrame) -> DataFrame:
    """Trim / lower-case text, fall back through three date sources, round and cast numbers."""
    out = {c: F.trim(F.col(f"`{c}`")) for c in TRIM_COLUMNS}
    out.update({c: lower_trim(c) for c in LOWER_TRIM_COLUMNS})
    out["event_date"] = resolved_event_date()
    # NaN → NULL here too (idempotent): Silver may be built straight from a
    # parsed stream, and a NaN amount would otherwise survive the clamps.
    for c in ("product_price", "discount_percent", "sales"):
        out[c] = money_round(nan_to_null(F.col(c).cast("double")))
    out["quantity"] = F.col("quantity").cast("int")
    out["removed_quantity"] = F.col("removed_quantity").cast("int")
    return df.withColumns(out).drop("event_date_parsed")


def clamp(df: DataFrame) -> DataFrame:
    """Negative price → NULL; negative quantities → 0; discount into [0, 100].
    NULL stays NULL; `sales` is not clamped."""
    price, qty, disc, removed = (F.col(c) for c in ("product_price", "quantity", "discount_percent", "removed_quantity"))
    return df.withColumns(
        {
            "product_price": F.when(price < 0, F.lit(None).cast("double")).otherwise(price),
            "quantity": F.when(qty < 0, F.lit(0)).otherwise(qty),
            "discount_percent": F.when(disc < 0, F.lit(0.0)).when(disc > 100, F.lit(100.0)).otherwise(disc),
            "removed_quantity": F.when(removed < 0, F.lit(0)).otherwise(removed),
        }
    )


def dedup_order() -> list:
    """Latest event time wins, then the highest offset, then the highest partition
    (offsets are unique only within a Kafka partition)."""
    return [
        F.col("event_timestamp").desc_nulls_last(),
        F.col("offset").desc_nulls_last(),
        F.col("partition").desc_nulls_last(),
    ]


def deduplicate(df: DataFrame, key: str = "event_id", whole: bool = False) -> DataFrame:
    """Keep one row per key: ROW_NUMBER() OVER (PARTITION BY key ORDER BY …) = 1.

    `whole`: every column of `df` is wanted, so the texts cross the shuffle packed. Else
    columns that nobody reads are left out of it.
    """
    if whole:
        return with_packed_texts(df, lambda rows: deduplicate(rows, key), keep=(key,))
    w = Window.partitionBy(key).orderBy(*dedup_order())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


#: The derived columns and what they read.
DERIVED = {"net_quantity": ("quantity", "removed_quantity"), "discount_amount": ("product_price", "quantity", "discount_percent")}


def derive(df: DataFrame, names: Iterable[str] = DERIVED) -> DataFrame:
    """net_quantity and discount_amount (DECIMAL arithmetic, HALF_UP to cents; for a
    price outside the exact range the DOUBLE product), or those of them in `names`."""
    qty = F.coalesce(F.col("quantity"), F.lit(0))
    net = F.greatest(F.col("quantity") - F.coalesce(F.col("removed_quantity"), F.lit(0)), F.lit(0))
    price, percent = F.coalesce(F.col("product_price"), F.lit(0.0)), F.coalesce(F.col("discount_percent"), F.lit(0.0))
    exact = in_exact_range(price)
    amount = (
        F.when(exact, price).cast(DecimalType(38, 2))
        * qty.cast(DecimalType(10, 0))
        * percent.cast(DecimalType(5, 2))
        * F.lit(0.01).cast(DecimalType(3, 2))
    )
    wide = price * qty * percent / F.lit(100.0)
    made = {"net_quantity": net, "discount_amount": F.when(exact, F.round(amount, 2).cast("double")).otherwise(wide)}
    return df.withColumns({c: made[c] for c in names})


#: What `deduplicate` reads.
DEDUP_INPUT = ("event_id", "event_timestamp", "offset", "partition")


def silver_events(bronze: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The whole Silver chain as one lazy plan (no actions). With `columns`, those alone,
    all of which the caller reads: they cross the shuffle packed (see `deduplicate`)."""
    rows = clamp(standardize(keep_required(bronze)))
    if columns is None:
        return derive(deduplicate(rows)).select(*SILVER_COLUMNS)
    derived = [c for c in DERIVED if c in columns]
    needed = {*columns, *DEDUP_INPUT, *(x for c in derived for x in DERIVED[c])}
    latest = deduplicate(rows.select(*[f"`{c}`" for c in rows.columns if c in needed]), whole=True)
    return (derive(latest, derived) if derived else latest).select(*[f"`{c}`" for c in columns])
