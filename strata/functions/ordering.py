"""Positions and successors in a sorted order, without a task that sees a whole group.

Rows are dealt to range partitions of the order and stored with the number of
their partition. Inside a partition (bounded by the session's shuffle
partitions) a window sees a part of a group only; across partitions one row per
(group, partition) is enough. A group of any size is thus spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def in_parts(rows: DataFrame, order: list[Column], path: str) -> DataFrame:
    """`rows` stored with `part`, the number of their range partition in `order`.
    Rows equal in all of `order` may lie in neighbouring partitions."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.monotonically_increasing_id()
    rows.repartitionByRange(parts, *order, spread).withColumn("part", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def _over(group: list[str]):
    return Window.partitionBy(*group).orderBy("part")


def positions(stored: DataFrame, group: list[str], order: list[Column], name: str = "pos") -> DataFrame:
    """Adds `name`: the row's position (from 1) in its group. `order` is the one
    that `in_parts` got; equal rows take successive positions. `group` may be empty."""
    counts = stored.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("__c"))
    before = counts.withColumn("__before", F.sum("__c").over(_over(group)) - F.col("__c")).drop("__c")
    inside = F.row_number().over(Window.partitionBy(*group, "part").orderBy(*order))
    return stored.withColumn(name, inside).join(before, [*group, "part"]).withColumn(name, F.col(name) + F.col("__before")).drop("__before")


def next_in_group(stored: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """Adds `name`: the `value` of the group's next row in the order of `value`
    (null at its end). The order of `in_parts` is the group's columns, then `value`."""
    firsts = stored.groupBy(*group, "part").agg(F.min(value).alias("__first"))
    firsts = firsts.withColumn("__after", F.lead("__first").over(_over(group))).drop("__first")
    inside = F.lead(value).over(Window.partitionBy(*group, "part").orderBy(value))
    return stored.withColumn(name, inside).join(firsts, [*group, "part"]).withColumn(name, F.coalesce(name, "__after")).drop("__after")
