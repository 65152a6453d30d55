import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import whitening
from strata.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(vectors):
    """Distinct integer vectors, their exact covariance, and the whitening by numpy."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    u = sorted(set(map(tuple, x)))
    n, dims = len(u), len(u[0])
    sums = [sum(v[i] for v in u) for i in range(dims)]
    cov = [[sum((n * v[i] - sums[i]) * (n * v[j] - sums[j]) for v in u) for j in range(dims)] for i in range(dims)]
    cov = np.array([[float(Fraction(c, n**3)) for c in row] for row in cov])
    e, w = np.linalg.eigh(cov)
    e, w = e[::-1], w[:, ::-1]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in x])
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    return n, e, centred @ w, deviation, np.trace(cov)


def check(rows, vectors):
    """rows of `whiten` in vec_id order 0, 1, ... against `brute`."""
    n, e, projected, deviation, trace = brute(vectors)
    k = min(16, int((e > 1e-13 * trace).sum()))
    assert sorted((r["vec_id"], r["component"]) for r in rows) == [(i, c) for i in range(len(vectors)) for c in range(1, k + 1)]
    got = np.zeros((len(vectors), k))
    for r in rows:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n
        assert r["deviation"] == (deviation[r["vec_id"]] if deviation[r["vec_id"]] < 1 << 63 else None)
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / trace, rel=1e-9)
        assert r["identity_error"] < 1e-6
    want = projected[:, :k] / np.sqrt(e[:k])
    sign = np.sign((got * want).sum(axis=0))
    assert np.allclose(got, want * sign, atol=1e-6)


def test_equals_exact_covariance_of_distinct_vectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PACK_ROWS", 64)
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 20)) * np.linspace(0.2, 4, 20) + 50).tolist()
    vectors += vectors[:100] + [vectors[0]] * 50
    df = spark.createDataFrame(list(enumerate(vectors)), SCHEMA).withColumn("x", F.lit(1)).withColumn("n", F.lit(2))
    check(whitening.whiten(df).collect(), vectors)


def test_whole_table(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/embeddings.parquet").orderBy("vec_id").collect()
    check(QUERIES["op12_whitening"](spark, sf_small).collect(), [r["embedding"] for r in table])


def test_wide_ranges_stay_exact(spark):
    vectors = [[0.0, 1e9], [1e9, 0.5], [3.0, -1e9], [-7e8, 12.25]]
    check(whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), SCHEMA)).collect(), vectors)


def test_plane_counts_are_cross_products():
    rng = np.random.default_rng(5)
    y = rng.integers(0, 1 << np.array([1, 5, 9, 13]), size=(131, 4))
    bits = [1, 5, 9, 13]
    counts = whitening.plane_counts(y, bits)
    for i in range(4):
        for j in range(i, 4):
            assert sum(int(c) << s for s, c in enumerate(counts[i, j])) == int((y[:, i] * y[:, j]).sum())


def test_unusable_rows_take_no_part(spark):
    good = [[0.0, 1.0], [1.0, 0.0], [2.0, 5.0]]
    bad = [None, [], [1.0], [float("nan"), 0.0], [float("inf"), 0.0], [None, 1.0], [1e300, 0.0]]
    df = spark.createDataFrame(list(enumerate(good)) + [(9, b) for b in bad], SCHEMA)
    check(whitening.whiten(df).collect(), good)


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (None, [1.0, 2.0])]])
def test_without_variance_the_result_is_empty(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_constant_dimension_and_null_id(spark):
    vectors = [[3.0, 1.0], [3.0, 2.0], [3.0, 4.0]]
    rows = whitening.whiten(spark.createDataFrame([(None if i == 2 else i, v) for i, v in enumerate(vectors)], SCHEMA)).collect()
    assert sorted((r["vec_id"] is None, r["component"]) for r in rows) == [(False, 1), (False, 1), (True, 1)]
    assert all(r["explained"] == pytest.approx(1.0) for r in rows)
