"""V6 on increments: Silver after new Bronze rows, without shuffling all of history.

A history row can only be superseded by a new row with its event_id. A table of
bits over the new ids, one 64-bit word per hash and four bits per id, is broadcast
while it is small; history rows that miss it pass straight through, the few that hit
it meet the new rows in the one dedup shuffle. A false hit only passes through the
shuffle. History is scanned twice (kept and possibly superseded rows), shuffled not at all
beyond the hits. For more new ids than the table is made for, all rows meet in one
shuffle on the id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.packing import with_packed_texts
from strata.operators import silver as S
from strata.schema import SILVER_COLUMNS

#: Bits of the table per new id; new ids up to which it is broadcast (6 bytes each, about 60 MB).
BITS_PER_ID, BROADCAST_IDS = 24, 10_000_000


def _word(words: int) -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(words))


def _mask() -> Column:
    """Four of 64 bits, from a hash that the word number does not depend on."""
    h = F.xxhash64(F.lit(17), F.col("event_id"))
    bits = None
    for i in range(4):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
        bits = one if bits is None else bits.bitwiseOR(one)
    return bits


def possibly_superseded(history: DataFrame, ids: DataFrame, n: int, broadcast_ids: int = BROADCAST_IDS) -> tuple[DataFrame, DataFrame]:
    """(rows whose event_id is surely not among `ids`, the others). `n` is the number
    of rows of `ids`; above `broadcast_ids` both parts come from a shuffle join on the id."""
    if n > broadcast_ids:
        marked = history.join(ids.select("event_id", F.lit(True).alias("_hit")).distinct(), "event_id", "left")
        hit = F.coalesce("_hit", F.lit(False))
        return marked.where(~hit).drop("_hit"), marked.where(hit).drop("_hit")
    words = max(1, math.ceil(n * BITS_PER_ID / 64))
    table = ids.select(_word(words).alias("_word"), _mask().alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    marked = history.withColumn("_word", _word(words)).join(F.broadcast(table), "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(_mask()) == _mask(), F.lit(False))
    return marked.where(~hit).drop("_word", "_bits"), marked.where(hit).drop("_word", "_bits")


def _refresh_in_one_shuffle(history: DataFrame, new: DataFrame) -> DataFrame:
    """History rows whose id no new row has, and the latest row of every other id. A null
    id of history equals no new one."""
    both = history.select(*SILVER_COLUMNS, F.lit(False).alias("_new")).unionByName(new.select(*SILVER_COLUMNS, F.lit(True).alias("_new")))

    def latest(rows: DataFrame) -> DataFrame:
        apart = rows.withColumn("_apart", F.col("event_id").isNull() & ~F.col("_new"))
        same_id = Window.partitionBy("event_id", "_apart")
        ranked = apart.withColumn("_rn", F.row_number().over(same_id.orderBy(*S.dedup_order()))).withColumn("_met", F.max("_new").over(same_id))
        return ranked.where(~F.col("_met") | (F.col("_rn") == 1))

    return with_packed_texts(both, latest, keep=("event_id",)).select(*SILVER_COLUMNS)


def refresh_silver(history: DataFrame, new: DataFrame, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """Silver of all rows so far, from stored Silver and the stored Silver of the new
    Bronze rows alone (`silver.silver_events`): equal to the full refresh."""
    n = new.count()
    if n > broadcast_ids:
        return _refresh_in_one_shuffle(history, new)
    kept, old = possibly_superseded(history, new.select("event_id"), n, broadcast_ids)
    return kept.select(*SILVER_COLUMNS).unionByName(S.deduplicate(old.select(*SILVER_COLUMNS).unionByName(new.select(*SILVER_COLUMNS)), whole=True))
