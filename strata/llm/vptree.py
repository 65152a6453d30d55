"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt to shards by id hash. In a shard, equal vectors are one point
that carries its smallest ids; the points form a vantage-point tree under the
Euclidean distance of the unit vectors, which orders like the cosine. A query
descends the near side first; the far side is skipped when the triangle
inequality says that nothing there can be nearer than the worst kept neighbour:
`factor` * (distance to the border) > worst. With factor 1 the search is exact;
a larger factor skips more and may miss neighbours. A second descent collects every
point within rounding of the last kept cosine, so that ties of any number are ranked
by their exact scores and ids. Query blocks meet every
shard; each visit of a node serves all its queries in one numpy step. The trees
are stored in the shared folder, one row per shard.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.session import scratch_path

SHARD_ROWS, BLOCK_ROWS, LEAF = 4096, 1024, 48
#: Cosines this close are decided by the exact score; distances near zero are only good to the square root of a rounding error.
EPS, EPS_DISTANCE = 1e-9, 1e-7
#: Vector components compared at once when exact scores are taken.
SCORE_CELLS = 1 << 21


@dataclass
class Tree:
    """Unit vectors in leaf order, original vectors, ids and row numbers per point,
    nodes (vantage point, radius, inner, outer; or leaf range)."""

    unit: np.ndarray
    raw: np.ndarray
    ids: list[np.ndarray]
    rows: list[np.ndarray]
    nodes: list[tuple]


def scaled(raw: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings the largest component near 1: exact, same
    directions, and no square leaves the range of doubles."""
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1, initial=0.0))[1][:, None])


def to_unit(raw: np.ndarray) -> np.ndarray:
    raw = scaled(raw)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def build(ids: np.ndarray, raw: np.ndarray, keep_ids: int, rows: np.ndarray | None = None) -> Tree:
    """A tree over float64 rows; a point keeps the `keep_ids` rows of smallest id, which
    is all that a result of fewer neighbours can hold."""
    rows = np.arange(len(ids)) if rows is None else rows
    order = np.lexsort((rows, ids))
    ids, raw, rows = ids[order], raw[order], rows[order]
    points, back = np.unique(raw, axis=0, return_inverse=True)
    back = back.reshape(-1)
    by = np.argsort(back, kind="stable")
    cut = np.searchsorted(back[by], np.arange(len(points) + 1))
    of = [by[a : min(b, a + keep_ids)] for a, b in zip(cut[:-1], cut[1:])]
    unit = to_unit(points)
    place: list[int] = []
    nodes: list[tuple] = []

    def grow(part: np.ndarray) -> int:
        number = len(nodes)
        nodes.append(())
        if len(part) <= LEAF:
            nodes[number] = (None, len(place), len(place) + len(part))
            place.extend(part.tolist())
            return number
        # The vantage point is the row farthest from the first one.
        d0 = unit[part] @ unit[part[0]]
        v = int(d0.argmin())
        d = np.sqrt(np.maximum(0, 2 - 2 * (unit[part] @ unit[part[v]])))
        radius = float(np.median(d))
        inner = d <= radius
        if inner.all() or not inner.any():
            nodes[number] = (None, len(place), len(place) + len(part))
            place.extend(part.tolist())
            return number
        a = grow(part[inner])
        b = grow(part[~inner])
        nodes[number] = (unit[part[v]], radius, a, b)
        return number

    grow(np.arange(len(points)))
    at = np.array(place)
    return Tree(unit[at], points[at], [ids[of[i]] for i in at], [rows[of[i]] for i in at], nodes)


def search(tree: Tree, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(point numbers, cosines, compared pairs) of the nearest `k` points of every unit query row, -1 where fewer exist."""
    best = np.full((len(queries), k), -np.inf)
    who = np.full((len(queries), k), -1)
    compared = 0

    def visit(number: int, q: np.ndarray) -> None:
        nonlocal compared
        node = tree.nodes[number]
        if node[0] is None:
            a, b = node[1], node[2]
            compared += len(q) * (b - a)
            value = np.concatenate([best[q], queries[q] @ tree.unit[a:b].T], axis=1)
            name = np.concatenate([who[q], np.broadcast_to(np.arange(a, b), (len(q), b - a))], axis=1)
            top = np.argsort(-value, axis=1, kind="stable")[:, :k]
            best[q], who[q] = np.take_along_axis(value, top, 1), np.take_along_axis(name, top, 1)
            return
        point, radius, inner, outer = node
        d = np.sqrt(np.maximum(0, 2 - 2 * (queries[q] @ point)))
        near = d <= radius
        for side, first, second in ((near, inner, outer), (~near, outer, inner)):
            mine = q[side]
            if not len(mine):
                continue
            visit(first, mine)
            worst = np.sqrt(np.maximum(0, 2 - 2 * np.maximum(best[mine, -1], -1.0)))
            worst = np.where(np.isfinite(best[mine, -1]), worst, np.inf)
            far = mine[factor * np.abs(d[side] - radius) <= worst + EPS]
            if len(far):
                visit(second, far)

    if len(queries) and tree.nodes:
        visit(0, np.arange(len(queries)))
    return who, best, compared


def collect(tree: Tree, queries: np.ndarray, floor: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """(query row, point number) of all points whose cosine reaches the query's `floor`."""
    q_out: list[np.ndarray] = []
    point_out: list[np.ndarray] = []
    reach = np.where(np.isfinite(floor), np.sqrt(np.maximum(0, 2 - 2 * np.maximum(floor, -1.0))) + EPS_DISTANCE, np.inf)

    def visit(number: int, q: np.ndarray) -> None:
        node = tree.nodes[number]
        if node[0] is None:
            a, b = node[1], node[2]
            row, column = np.nonzero(queries[q] @ tree.unit[a:b].T >= floor[q][:, None])
            q_out.append(q[row])
            point_out.append(a + column)
            return
        point, radius, inner, outer = node
        gap = np.sqrt(np.maximum(0, 2 - 2 * (queries[q] @ point))) - radius
        for number, far in ((inner, gap > 0), (outer, gap <= 0)):
            mine = q[~far | (factor * np.abs(gap) <= reach[q])]
            if len(mine):
                visit(number, mine)

    if len(queries) and tree.nodes:
        visit(0, np.arange(len(queries)))
    return np.concatenate(q_out or [np.zeros(0, np.int64)]), np.concatenate(point_out or [np.zeros(0, np.int64)])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision, sums taken from left to right."""
    a, b = scaled(a), scaled(b)

    def total(x: np.ndarray) -> np.ndarray:
        return np.cumsum(x, axis=1)[:, -1]

    return total(a * b) / (np.sqrt(total(a * a)) * np.sqrt(total(b * b)))


def usable(vector: Column) -> Column:
    """True for vectors that take part: no null or non-finite component, not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(odd, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def index(vectors: DataFrame, folder: str, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = SHARD_ROWS, k: int = 5) -> DataFrame:
    """Stores a tree per (dimension, shard) under `folder` and returns the table. Every
    usable row is indexed; rows are known by a number that is stored with them."""
    spark: SparkSession = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vec")))
    rows.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/vectors")
    rows = spark.read.parquet(f"{folder}/vectors")
    shards = max(1, math.ceil(rows.count() / shard_rows))

    def make(table: pa.Table) -> pa.Table:
        n = table.num_rows
        raw = table["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        tree = build(table["id"].to_numpy(), raw, k + 1, table["row"].to_numpy())
        return pa.table({"dim": pa.array([raw.shape[1]], pa.int32()), "shard": pa.array([table["shard"][0].as_py()], pa.int64()), "tree": pa.array([pickle.dumps(tree, protocol=5)], pa.binary())})

    (
        rows.withColumn("dim", F.size("vec")).withColumn("shard", F.pmod(F.xxhash64("id", "row"), F.lit(shards)).cast("bigint"))
        .groupBy("dim", "shard").applyInArrow(make, "dim int, shard bigint, tree binary").write.parquet(f"{folder}/trees")
    )
    return spark.read.parquet(f"{folder}/trees")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, factor: float = 1.0, id_col: str = "vec_id", vec_col: str = "embedding",
            shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the `k` nearest other rows of every query
    row, nearest first, ties to the smaller id; fewer where fewer exist.

    `is_query` is a condition on a column `id`. Null, empty, zero and non-finite
    vectors and rows without id take no part; vectors of another dimension are no
    candidates. Rows that share an id are rows of their own: each is a candidate of the
    others, and each query row among them has a result. An empty table gives an
    empty result. Other columns are not read.
    """
    spark: SparkSession = vectors.sparkSession
    folder = scratch_path(spark, "vptree")
    trees = index(vectors, folder, id_col, vec_col, shard_rows, k)
    asked = spark.read.parquet(f"{folder}/vectors").where(is_query)
    blocks = max(1, math.ceil(asked.count() / block_rows))
    shards = spark.read.parquet(f"{folder}/trees").select(F.col("dim").alias("dim"), F.col("shard").alias("shard"))
    by_block = trees.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    # Every query block meets every shard of its dimension: an equality join on the dimension of the stated query set.
    asked = asked.withColumn("dim", F.size("vec")).withColumn("block", F.pmod(F.xxhash64(F.lit(3), "id", "row"), F.lit(blocks)).cast("bigint"))
    asked = asked.join(shards, "dim").select("dim", F.col("shard").alias("to_shard"), "block", "id", "row", "vec").withColumnRenamed("to_shard", "shard")

    def look(tree_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        out = {"query_id": [], "query_row": [], "vec_id": [], "row": [], "score": []}
        if tree_rows.num_rows and query_rows.num_rows:
            tree: Tree = pickle.loads(tree_rows["tree"][0].as_py())
            ids, own = query_rows["id"].to_numpy(), query_rows["row"].to_numpy()
            raw = query_rows["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            unit = to_unit(raw)
            # One point more than k: the query's own may be among them.
            _, best, _ = search(tree, unit, k + 1, factor)
            q, point = collect(tree, unit, best[:, -1] - EPS, factor)
            step = max(1, SCORE_CELLS // raw.shape[1])
            score = np.concatenate([cosine(raw[q[i : i + step]], tree.raw[point[i : i + step]]) for i in range(0, len(q), step)] or [np.zeros(0)])
            count = np.array([len(x) for x in tree.ids])[point]
            none = [np.zeros(0, np.int64)]
            name, row = np.concatenate([tree.ids[p] for p in point] or none), np.concatenate([tree.rows[p] for p in point] or none)
            q, score = np.repeat(q, count), np.repeat(score, count)
            other = row != own[q]
            q, score, name, row = q[other], score[other], name[other], row[other]
            order = np.lexsort((row, name, -score, q))
            q, score, name, row = q[order], score[order], name[order], row[order]
            top = np.arange(len(q)) - np.searchsorted(q, q) < k
            out = {"query_id": ids[q[top]], "query_row": own[q[top]], "vec_id": name[top], "row": row[top], "score": score[top]}
        return pa.table([pa.array(out[f.name], f.type) for f in result], schema=result)

    result = pa.schema([(c, pa.int64()) for c in ("query_id", "query_row", "vec_id", "row")] + [("score", pa.float64())])
    found = by_block.groupBy("dim", "shard", "block").cogroup(asked.groupBy("dim", "shard", "block")).applyInArrow(look, "query_id bigint, query_row bigint, vec_id bigint, row bigint, score double")
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id"), F.col("row")))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(every: int = 50, k: int = 5) -> str:
    """The same search in DuckDB SQL: all pairs, sums folded from left to right."""
    dot = "list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2])), lambda x, y: x + y)"
    return f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT vec_id, e, sqrt({dot.format(a='e', b='e')}) AS l FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, {dot.format(a='q.e', b='c.e')} / (q.l * c.l) AS score FROM n q JOIN n c ON q.vec_id % {every} = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {k}
"""
