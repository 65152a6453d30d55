"""Embedding whitening from a bit-sliced scatter matrix.

Entries become integers x = floor(scale * c) + shift. The fit list holds each
distinct x vector once.

1. *Range.* One aggregation gives the least and largest x of every dimension; x
   less the least is a non-negative integer of few bits.
2. *Scatter.* A task packs each dimension's bit planes across its rows into 64-bit
   words. The cross-product of two dimensions is the sum over pairs of planes of
   2^(p + q) times the number of bits set in both; the counts of each weight are
   added up in Spark, so every cross-product and sum is an exact integer.
3. *Centring.* n * sum(x_i x_j) - S_i S_j in Python integers is n^2 times the
   covariance, to the last digit, whatever the shift. Only then it becomes a double
   matrix for eigh.
4. *Projection.* Each row's n * x - S is an exact integer too; its projection on a
   component over the root of the eigenvalue is the whitened value.

What the driver holds depends on dimensions and bits, not on rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from strata.session import scratch_path

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Rows packed at once (a multiple of 64), and rows projected at once.
PACK_ROWS, PROJECT_ROWS = 1 << 14, 1 << 12
#: Eigenvalues below this share of the largest are rounding errors of zero.
RANK = 1e-13
#: |floor(scale * c)| has to stay below this, so that x is a long.
MOST = float(1 << 62)


def integer_vectors(embeddings: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x) of the usable rows.

    Rows go whose vector is null or empty, or holds null or non-finite entries or
    entries too large for a long. Of several vector lengths the most frequent one
    stays (of equally frequent ones the longest). Rows with a null or repeated
    vec_id stay.
    """
    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.transform(vec_col, lambda c: c.cast("double") * F.lit(float(scale))).alias("v"))
    rows = rows.where(F.size("v") > 0).where(F.forall("v", lambda c: F.coalesce(F.abs(c) < MOST, F.lit(False))))
    rows = rows.select("vec_id", F.transform("v", lambda c: F.floor(c) + F.lit(shift).cast("bigint")).alias("x"))
    width = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("x") == (width["d"] if width else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """The int64 rows of a list column of equal lengths without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), -1)


def plane_counts(y: np.ndarray, bits: list[int]) -> np.ndarray:
    """counts[i, j, s]: over rows, the number of pairs of a set bit p of y_i and q of
    y_j with p + q = s, from planes packed across rows; for i <= j."""
    rows, dims = y.shape
    words = -(-rows // 64)
    planes = np.zeros((sum(bits), words), np.uint64)
    dim = np.repeat(np.arange(dims), bits)
    power = np.concatenate([np.arange(b) for b in bits]) if len(dim) else np.zeros(0, int)
    for at, (i, p) in enumerate(zip(dim, power)):
        bit = np.zeros(words * 64, np.uint8)
        bit[:rows] = (y[:, i] >> p) & 1
        planes[at] = np.packbits(bit, bitorder="little").view(np.uint64)
    out = np.zeros((dims, dims, 2 * max(bits, default=0) + 1), np.int64)
    for at, (i, p) in enumerate(zip(dim, power)):
        first = int(np.searchsorted(dim, i))
        both = np.bitwise_count(planes[first:] & planes[at]).sum(axis=1, dtype=np.int64)
        out[i, dim[first:], power[first:] + p] += both
    return out


def _scatter(low: np.ndarray, bits: list[int]):
    """Per task: rows (i, j, s, n) of plane counts; sums of a dimension have j = -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, held, waiting = None, None, [], 0

        def pack() -> None:
            nonlocal counts, sums, held, waiting
            y = np.concatenate(held)
            more = plane_counts(y, bits)
            ones = np.array([[int(((y[:, i] >> p) & 1).sum()) if p < bits[i] else 0 for p in range(more.shape[2])] for i in range(y.shape[1])], np.int64)
            counts, sums = (more, ones) if counts is None else (counts + more, sums + ones)
            held, waiting = [], 0

        for rb in batches:
            for a in range(0, rb.num_rows, PACK_ROWS):
                held.append(_matrix(rb.column(0).slice(a, PACK_ROWS)) - low)
                waiting += len(held[-1])
                if waiting >= PACK_ROWS:
                    pack()
        if waiting:
            pack()
        if counts is not None:
            i, j, s = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (i, j, s, counts[i, j, s])], ["i", "j", "s", "n"])
            i, s = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (i, np.full(len(i), -1), s, sums[i, s])], ["i", "j", "s", "n"])

    return run


@dataclass
class Whitening:
    """A fitted model: rows of the fit list, least x and sum of (x - least) per
    dimension, unit components (rows), their eigenvalues and the trace."""

    n: int
    low: list[int]
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0


def centred_scatter(n: int, sums: list[int], products: dict[tuple[int, int], int]) -> list[list[int]]:
    """n * sum(y_i y_j) - S_i S_j: n squared times the covariance, exactly."""
    dims = len(sums)
    return [[n * products.get((min(i, j), max(i, j)), 0) - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The model of a fit list of distinct vectors `x`; None for an empty one.
    Components of no variance are left out."""
    by_dim = distinct.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n"))
    span = by_dim.orderBy("i").collect()
    if not span:
        return None
    n, low = span[0]["n"], [r["lo"] for r in span]
    bits = [(r["hi"] - r["lo"]).bit_length() for r in span]
    counts = distinct.select("x").mapInArrow(_scatter(np.array(low, np.int64), bits), "i bigint, j bigint, s bigint, n bigint")
    products: dict[tuple[int, int], int] = {}
    sums = [0] * len(low)
    for r in counts.groupBy("i", "j", "s").agg(F.sum("n").alias("n")).collect():
        if r["j"] < 0:
            sums[r["i"]] += r["n"] << r["s"]
        else:
            products[r["i"], r["j"]] = products.get((r["i"], r["j"]), 0) + (r["n"] << r["s"])
    exact = centred_scatter(n, sums, products)
    matrix = np.array([[v / (n * n) for v in row] for row in exact])
    trace = sum(exact[i][i] for i in range(len(low))) / (n * n)
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > RANK * max(trace, 0.0)]
    return Whitening(n, low, sums, np.ascontiguousarray(vectors[:, order].T), values[order], trace)


def _centred(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """(n * x - S as exact integers, (x - S / n) as doubles); Python integers where a long could overflow."""
    low = np.array(model.low, np.int64)
    y = x - low
    room = model.n * int(y.max(initial=0)) + max((abs(s) for s in model.sums), default=0) < 1 << 62
    whole = (y if room else y.astype(object)) * model.n - np.array(model.sums, np.int64 if room else object)
    return whole, (whole / model.n).astype(np.float64)


def _projected(model: Whitening):
    w = model.components / np.sqrt(model.values)[:, None]

    def run(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole, centred = _centred(x, model)
        # One sum per component in a fixed order of dimensions, so equal vectors get equal values in any batch.
        out = np.zeros((len(x), len(w)))
        for i in range(x.shape[1]):
            out += centred[:, i : i + 1] * w[:, i]
        return whole, out

    return run


def measure_identity(distinct: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    project = _projected(model)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cross, total = np.zeros((k, k)), np.zeros(k)
        for rb in batches:
            for a in range(0, rb.num_rows, PROJECT_ROWS):
                _, z = project(_matrix(rb.column(0).slice(a, PROJECT_ROWS)))
                cross += z.T @ z
                total += z.sum(axis=0)
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([i, np.arange(k)])), pa.array(np.concatenate([j, np.full(k, -1)])), pa.array(np.concatenate([cross.reshape(-1), total]))], ["i", "j", "s"])

    sums = distinct.select("x").mapInArrow(run, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    cov, mean = np.zeros((k, k)), np.zeros(k)
    for r in sums:
        if r["j"] < 0:
            mean[r["i"]] = r["s"] / model.n
        else:
            cov[r["i"], r["j"]] = r["s"] / model.n
    # Whitened rows are centred already; what is left of their mean is rounding.
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0


def whiten(embeddings: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per usable row (see `integer_vectors`) and component: vec_id, component
    (from 1, by falling eigenvalue), n (rows of the fit list), deviation (sum over
    dimensions of (n * x - S)^2, exact; null where it is no long), whitened, explained
    (eigenvalue over trace), identity_error.

    Repeated rows each get their rows. Components without variance have no row; so a
    table whose usable rows are all one vector, and an empty table, give an empty
    result. Other columns are not read, whatever their names.
    """
    spark = embeddings.sparkSession
    base = scratch_path(spark, "whitening")
    vectors = integer_vectors(embeddings, vec_col, id_col, scale, shift)
    id_type = vectors.schema["vec_id"].dataType
    vectors.select("x").distinct().write.parquet(f"{base}/distinct")
    distinct = spark.read.schema("x array<bigint>").parquet(f"{base}/distinct")
    model = fit(distinct, components)
    out = StructType([StructField("vec_id", id_type), StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", LongType()),
                      StructField("whitened", DoubleType()), StructField("explained", DoubleType()), StructField("identity_error", DoubleType())])
    if model is None or not len(model.values):
        return spark.createDataFrame([], out)
    model.identity_error = measure_identity(distinct, model)
    project = _projected(model)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for a in range(0, rb.num_rows, PROJECT_ROWS):
                part = rb.slice(a, PROJECT_ROWS)
                whole, z = project(_matrix(part.column(1)))
                big = whole.shape[1] * int(np.abs(whole).max()) ** 2 >= 1 << 63
                square = ((whole.astype(object) if big else whole) ** 2).sum(axis=1).tolist()
                deviation = pa.array([v if v < 1 << 63 else None for v in square], pa.int64())
                each = pa.array(np.repeat(np.arange(len(z)), k))
                rows = len(z) * k
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(z))), pa.array(np.full(rows, model.n)), deviation.take(each),
                    pa.array(z.reshape(-1)), pa.array(np.tile(model.values / model.trace, len(z))), pa.array(np.full(rows, model.identity_error))], [f.name for f in out])

    return vectors.mapInArrow(run, out)
