"""Connected components of an edge table.

Edges are first contracted inside tasks: each task reads a bounded number of
them and returns a spanning forest of stars, which has fewer edges and the same
components. What fits one task's bound is finished there. A larger graph goes on
with Hash-to-Min rounds: every node sends its smallest neighbour to all its
neighbours, old edges are dropped, new ones made distinct, until the edge set no
longer changes and each component is a star around its smallest node. Hub nodes
stay rows of a join that adaptive execution can split; no neighbour list is ever
collected. Each step is checkpointed to the shared folder, so a lost executor
replays one step at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import checkpoint_root

#: Edges that one task contracts at once, about 100 bytes each while it does.
TASK_EDGES = 1_000_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of every node that is not that one."""
    node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    low = np.arange(len(node))
    while True:
        new = low.copy()
        least = np.minimum(low[x], low[y])
        for end in (x, y):
            np.minimum.at(new, low[end], least)
            np.minimum.at(new, end, least)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, low):
            break
        low = new
    moved = np.flatnonzero(low != np.arange(len(node)))
    return node[moved], node[low[moved]]


def _contract(limit: int):
    def run(batches):
        held, count = [], 0
        for rb in batches:
            held.append((rb.column(0).to_numpy(), rb.column(1).to_numpy()))
            count += rb.num_rows
            if count >= limit:
                yield _batch(held)
                held, count = [], 0
        if count:
            yield _batch(held)

    def _batch(held):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in stars(*(np.concatenate(c) for c in zip(*held)))], ["a", "b"])

    return run


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, component) for every node (bigint) that has an edge to another one;
    `component` is the smallest node of its component. No edges give an empty
    result. Edges with a null end, repeated edges and self-loops have no effect."""
    checkpoint_root(edges.sparkSession)
    forest = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("a"), F.col(b).alias("b")).checkpoint(eager=True)
    size, before, one_task = forest.count(), math.inf, False
    while not one_task and size <= 0.7 * before:
        # Neighbouring partitions are read by one task, without a shuffle; a task works in runs of the bound.
        tasks = max(1, math.ceil(size / task_edges))
        one_task = tasks == 1
        forest = forest.coalesce(tasks).mapInArrow(_contract(task_edges), "a bigint, b bigint").checkpoint(eager=True)
        size, before = forest.count(), size
    star = forest.select(F.col("a").alias("node"), F.col("b").alias("low"))
    if not one_task:
        star = _rounds(star)
    return star.select("node", F.col("low").alias("component")).unionByName(
        star.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())


def _rounds(star: DataFrame) -> DataFrame:
    """Hash-to-Min until the edges are stars."""
    star = star.distinct().checkpoint(eager=True)
    seen = None
    while True:
        mark = tuple(star.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "low").cast("decimal(38,0)"))).first())
        if mark[0] == 0 or mark == seen:
            return star
        seen = mark
        both = star.select(F.explode(F.array(F.struct(F.col("node").alias("u"), F.col("low").alias("v")), F.struct(F.col("low").alias("u"), F.col("node").alias("v")))).alias("e")).select("e.u", "e.v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        sent = both.join(least, "u")
        star = (
            sent.select(F.explode(F.array("v", "u")).alias("x"), "m").where(F.col("x") != F.col("m"))
            .select(F.greatest("x", "m").alias("node"), F.least("x", "m").alias("low"))
            .distinct().checkpoint(eager=True)
        )
