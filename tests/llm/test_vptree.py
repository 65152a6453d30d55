import numpy as np
from pyspark.sql import functions as F

from strata.llm import vptree

SCHEMA = "vec_id bigint, embedding array<float>, label int, id bigint, shard string"


def brute(ids, raw, queries, k=5):
    out = []
    for q in queries:
        i = int(np.flatnonzero(ids == q)[0])
        other = ids != q
        score = vptree.cosine(np.broadcast_to(raw[i], raw[other].shape), raw[other])
        order = np.lexsort((ids[other], -score))[:k]
        out += [(int(q), n + 1, int(ids[other][j]), float(score[j])) for n, j in enumerate(order)]
    return sorted(out)


def make(n, dims, seed, copies=0):
    r = np.random.default_rng(seed)
    raw = r.normal(size=(n, dims)).astype(np.float32)
    if copies:
        raw[r.permutation(n)[:copies]] = raw[0]
    return np.arange(n), raw.astype(np.float64)


def test_factor_one_is_exact_with_hot_copies(spark):
    ids, raw = make(700, 12, 1, copies=250)
    df = spark.createDataFrame([(int(i), [float(x) for x in v], 0, 1, "s") for i, v in zip(ids, raw)], SCHEMA)
    got = vptree.nearest(df, F.col("id") % 50 == 0, shard_rows=200, block_rows=6)
    assert sorted(map(tuple, got.collect())) == brute(ids, raw, ids[ids % 50 == 0])


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (1, [1.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (100, [1.0, 2.0, 3.0]), (1, [1.0, 1.0]), (1, [9.0, 9.0]), (150, None)]
    df = spark.createDataFrame([(i, v, 0, 2, "x") for i, v in rows], SCHEMA)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in vptree.nearest(df, F.col("id") % 50 == 0).collect())
    # Five usable rows of two dimensions, three of them with one id; the only vector of three dimensions has no candidate.
    assert got == [(q, rank, v) for q, other in ((0, 50), (50, 0)) for rank, v in enumerate((1, 1, 1, other), 1)]
    assert vptree.nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_relaxed_factor_compares_less_and_keeps_recall():
    r = np.random.default_rng(4)
    centre = r.normal(size=(60, 16))
    raw = (centre[r.integers(0, 60, 4000)] + 0.35 * r.normal(size=(4000, 16)))
    tree = vptree.build(np.arange(4000), raw, 6)
    q = raw[:80] / np.linalg.norm(raw[:80], axis=1, keepdims=True)
    exact, best, full = vptree.search(tree, q, 6, 1.0)
    truth = np.sort(q @ tree.unit.T, axis=1)[:, ::-1][:, :6]
    assert np.allclose(best, truth)
    loose, _, fewer = vptree.search(tree, q, 6, 1.6)
    recall = np.mean([len(set(a) & set(b)) / 6 for a, b in zip(exact, loose)])
    assert recall >= 0.9 and fewer < full < len(q) * 4000


def test_dozens_of_ties_go_to_the_smaller_id(spark):
    # 0/1 vectors: hundreds of distinct points share each cosine. Powers of two: distinct points of one direction.
    r = np.random.default_rng(7)
    raw = np.unique((r.random((2000, 14)) < 0.4).astype(np.float64), axis=0)
    raw = raw[raw.any(axis=1)]
    raw = np.concatenate([raw, raw[3] * 2.0 ** np.arange(1, 40)[:, None]])
    raw = raw[r.permutation(len(raw))]
    ids = np.arange(len(raw))
    df = spark.createDataFrame([(int(i), [float(x) for x in v], 0, 1, "s") for i, v in zip(ids, raw)], SCHEMA)
    got = vptree.nearest(df, F.col("id") % 20 == 0, shard_rows=700, block_rows=30)
    assert sorted(map(tuple, got.collect())) == brute(ids, raw, ids[ids % 20 == 0])


def test_rows_that_share_an_id_are_candidates_and_queries_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [1.0, 0.0]), (7, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0, 2, "x") for i, v in rows], SCHEMA)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in vptree.nearest(df, F.col("id") == 0, k=2).collect())
    half = round(0.5**0.5, 6)
    assert got == sorted([(0, 1, 0, 1.0), (0, 2, 7, half)] * 2 + [(0, 1, 7, half), (0, 2, 0, 0.0)])


def test_tiny_and_huge_components(spark):
    r = np.random.default_rng(9)
    raw = r.normal(size=(300, 6)) * 10.0 ** r.choice([-200, 0, 200], size=(300, 1))
    df = spark.createDataFrame([(i, [float(x) for x in v], 0, 1, "s") for i, v in enumerate(raw)], "vec_id bigint, embedding array<double>, label int, id bigint, shard string")
    got = vptree.nearest(df, F.col("id") % 50 == 0, shard_rows=100)
    assert sorted(map(tuple, got.collect())) == brute(np.arange(300), raw, np.arange(0, 300, 50))
