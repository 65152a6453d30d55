"""Distinct counts that add up: dense id numbers and daily bitmaps.

`COUNT(DISTINCT)` results of two days cannot be added, their bitmaps can be joined.
Every id of a kind gets a dense number once (`extend_dictionary`). A day's ids are
then bitmaps of 32,768 bits, one row per day, kind and number bucket. Any roll-up is
an OR of stored bitmaps and a bit count: it reads 4 KB per row whatever the
number of events, and a late day replaces only its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import in_exact_range, ordering, pct, to_cents
from strata.operators.gold import PURCHASE_TYPES
from strata.sources import sinks

#: What a day counts: a name, the id column, and the event types that count (all, if None).
KINDS = {
    "customers": ("user_id", None),
    "sessions": ("session_id", None),
    "products": ("product_id", None),
    "purchase_sessions": ("session_id", PURCHASE_TYPES),
}
ID_COLUMNS = ["user_id", "session_id", "product_id"]


def _ids(silver: DataFrame, column: str) -> DataFrame:
    return silver.where(F.col(column).isNotNull()).select(F.lit(column).alias("id_column"), F.col(column).alias("id")).distinct()


def extend_dictionary(known: DataFrame | None, silver: DataFrame, base: str) -> DataFrame:
    """Numbers for the ids of `silver` that `known` lacks, stored under `base`: per id
    column 1, 2, … in the order of the ids, after the numbers already given. Known
    numbers never change. The order is found over range partitions, in no single task."""
    found = None
    for c in ID_COLUMNS:
        found = _ids(silver, c) if found is None else found.unionByName(_ids(silver, c))
    if known is not None:
        found = found.join(known, ["id_column", "id"], "left_anti")
    stored = ordering.in_parts(found, [F.col("id_column"), F.col("id")], f"{base}/ids")
    new = ordering.positions(stored, ["id_column"], [F.col("id")], "no").select("id_column", "id", F.col("no").cast("bigint").alias("no"))
    if known is not None:
        top = known.groupBy("id_column").agg(F.max("no").alias("top"))
        new = new.join(top, "id_column", "left").select("id_column", "id", (F.col("no") + F.coalesce("top", F.lit(0))).alias("no"))
    return sinks.stage(new, f"{base}/numbers")


def daily_bitmaps(silver: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(event_date, kind, bucket, bits): the ids that occur on each day (a null day is
    one too), per kind. Rows meet the dictionary once per distinct (day, id)."""
    out = None
    for kind, (column, types) in KINDS.items():
        rows = silver.where(F.col(column).isNotNull())
        if types is not None:
            rows = rows.where(F.col("event_type").isin(*types))
        rows = rows.select("event_date", F.lit(kind).alias("kind"), F.lit(column).alias("id_column"), F.col(column).alias("id")).distinct()
        out = rows if out is None else out.unionByName(rows)
    numbered = out.join(dictionary, ["id_column", "id"]).select("event_date", "kind", F.bitmap_bucket_number("no").alias("bucket"), F.bitmap_bit_position("no").alias("bit"))
    # Numbers meet in their bitmap's task before they become bits: 4 KB rows are neither sorted nor shuffled.
    return numbered.repartition("event_date", "kind", "bucket").groupBy("event_date", "kind", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def daily_amounts(silver: DataFrame) -> DataFrame:
    """(event_date, events, cents, wide, quantity): sums that add up over days; `cents`
    is exact, `wide` the sum of the amounts beyond the exact range (null without any)."""
    return silver.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"), F.sum(to_cents("sales").cast("decimal(20,0)")).alias("cents"), F.sum(F.when(~in_exact_range("sales"), F.col("sales"))).alias("wide"),
        F.sum(F.coalesce("quantity", F.lit(0))).cast("bigint").alias("quantity"))


def distinct_counts(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct ids per `keys` and kind over any set of days."""
    joined = bitmaps.groupBy(*keys, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("ids"))
    return joined.groupBy(*keys, "kind").agg(F.sum("ids").cast("bigint").alias("ids"))


def executive_from_days(bitmaps: DataFrame, amounts: DataFrame) -> DataFrame:
    """D1 out of the stored daily rows alone, Silver is not read."""
    kinds = distinct_counts(bitmaps, []).select("kind", "ids")
    sums = amounts.agg(F.sum("cents").alias("cents"), F.sum("wide").alias("wide"), F.sum("quantity").alias("quantity"))
    # A few rows beside each other: one final aggregation over the union of both.
    both = kinds.unionByName(sums, allowMissingColumns=True)
    row = both.agg(
        *[F.coalesce(F.max(F.when(F.col("kind") == k, F.col("ids"))), F.lit(0)).cast("bigint").alias(k) for k in KINDS],
        F.max("cents").alias("cents"), F.max("wide").alias("wide"), F.max("quantity").cast("bigint").alias("total_quantity"))
    exact = (F.col("cents").cast("decimal(36,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("double")
    return row.select(
        F.when(F.col("wide").isNull(), exact).otherwise(exact + F.col("wide")).alias("total_sales"), F.col("customers").alias("total_customers"),
        F.col("sessions").alias("total_sessions"), "total_quantity", "purchase_sessions", pct("purchase_sessions", "sessions").alias("conversion_rate_percent"))
