import collections
import random

import numpy as np
import pytest
from conftest import WORD, thue_morse

from strata.llm import flat, ngram_join
from strata.llm.components import connected_components, stars

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows):
    """(n_shingles, component) per row number, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    at = collections.defaultdict(list)
    for i, s in enumerate(sets):
        both = collections.Counter(j for x in s for j in at[x])
        for j, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for x in s:
            at[x].append(i)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [(len(sets[i]), low.get(find(i))) for i in range(len(rows))]


def compare(df, rows):
    got = sorted((r["id"] is None, r["id"], r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_classes(df).collect())
    want = sorted((d is None, d, n, c) for (d, _), (n, c) in zip(rows, brute(rows)))
    assert [g[1:] for g in got] == [w[1:] for w in want]


def near_copies():
    """Groups around the threshold, a common passage, hot exact copies."""
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(30):
        base = [r.choice(vocabulary) for _ in range(r.choice([5, 6, 8, 12, 30, 80, 300]))]
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(copy) // 25))):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            if r.random() < 0.4:
                copy = copy[: r.randint(max(1, int(len(copy) * 0.7)), len(copy))]
            rows.append(" ".join(copy).upper() if r.random() < 0.3 else "\t".join(copy))
    rows += [" ".join(passage + [r.choice(vocabulary) for _ in range(r.randint(0, 120))]) for _ in range(40)]
    rows += [" ".join(passage)] * 40
    r.shuffle(rows)
    return [(i * 7 % 1009, t) for i, t in enumerate(rows)]


def test_near_copies_passages_and_hot_copies(documents):
    rows = near_copies()
    compare(documents(*rows).repartition(5), rows)


def test_whole_table(small_docs):
    compare(small_docs, [(r["doc_id"], r["text"]) for r in small_docs.collect()])


def test_null_empty_repeated_and_clashing(documents):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE  two"), (6, "one"), (7, long), (7, long), (8, long + " y"), (None, "one two"), (None, None), (2, ""), (9, "ÀB c d e f"), (10, "Àb C d e f"), (11, "àb c d e f")]
    df = documents(*[(d, t, "n", "sid", 1, 5, "b") for d, t in rows], extra=", sid bigint, bucket string")
    compare(df, rows)


def test_words_with_equal_polynomial_hashes_stay_apart(documents):
    a, b = thue_morse()
    rows = [(1, f"{a} one two three four five"), (2, f"{b} one two three four five"), (3, a), (4, b), (5, " ".join([a] * 8)), (6, " ".join([b] * 8))]
    compare(documents(*rows), rows)


def test_one_set_and_one_component_with_a_third_of_all_rows(documents):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(i, base) for i in range(600)] + [(1000 + i, base + f" tail{i}") for i in range(600)] + [(2000 + i, None) for i in range(600)] + [(3000, "other words of a lone text here")]
    compare(documents(*rows).repartition(7), rows)


def test_small_slices_and_buckets_lose_no_link(documents, monkeypatch):
    """Driver-side sizes only change how the count is cut."""
    monkeypatch.setattr(ngram_join, "BUCKET_BYTES", 4000)
    rows = near_copies()
    compare(documents(*rows).repartition(3), rows)


def test_shared_tokens_in_slices(monkeypatch):
    r = np.random.default_rng(2)
    rem = [r.integers(0, 50, 300).astype(np.uint32) for _ in range(4)]
    idx = [r.integers(0, 20, 300).astype(np.uint32) for _ in range(4)]
    sids = [r.integers(0, 30, 20) for _ in range(4)]
    sizes = [np.arange(20, dtype=np.uint32) for _ in range(4)]
    whole = ngram_join._shared_in(rem, idx, sids, sizes, [0, 1, 2, 3])
    monkeypatch.setattr(ngram_join, "SLICE_TOKENS", 100)
    cut = ngram_join._shared_in(rem, idx, sids, sizes, [0, 1, 2, 3])
    assert [x.tolist() for i, x in enumerate(whole) if i != 2] == [x.tolist() for i, x in enumerate(cut) if i != 2] and len(whole[0])


def test_empty_table(documents):
    assert ngram_join.jaccard_classes(documents().limit(0)).count() == 0


@pytest.mark.parametrize("rare", [0, 2, 10**9])
def test_linked_sets_share_a_signature(rare):
    r = np.random.default_rng(7)
    for _ in range(300):
        n = int(r.choice([2, 3, 4, 5, 8, 20, 70, 200]))
        x = flat.mix(r.integers(0, 10**6, n).astype(np.uint64))
        x = np.unique(x)
        y = np.unique(np.concatenate([x[r.random(len(x)) < r.choice([0.8, 0.9, 1.0])], flat.mix(r.integers(0, 10**6, int(r.integers(0, max(2, n // 8)))).astype(np.uint64))]))
        both = len(np.intersect1d(x, y))
        if not len(y) or 100 * both < 75 * (len(x) + len(y) - both) or min(len(x), len(y)) < 2:
            continue
        count = lambda z: (z % np.uint64(7)).astype(np.int64)  # noqa: E731  a function of the token alone
        a, b = (ngram_join.signatures(z, count(z), 75, rare) for z in (x, y))
        assert len(np.intersect1d(a, b)), (len(x), len(y), both)
        take = lambda z: z[: int(ngram_join.sample_size(np.int64(len(z)), 75, 0.4))]
        shared = len(np.intersect1d(take(x), take(y)))
        for z in (x, y):
            assert shared >= int(ngram_join.needed(np.array([len(z)]), 75, 0.4)[0])


@pytest.mark.parametrize("task_edges", [1_000_000, 40])
def test_components_one_task_and_rounds(spark, task_edges):
    r = random.Random(3)
    edges = [(r.randrange(-300, 300), r.randrange(-300, 300)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    root = {}

    def find(z):
        while root.get(z, z) != z:
            z = root[z]
        return z

    for a, b in edges:
        p, q = find(a), find(b)
        if p != q:
            root[max(p, q)] = min(p, q)
    want = {n: find(n) for a, b in edges if a != b for n in (a, b)}
    df = spark.createDataFrame(edges + [(None, 4)], "a bigint, b bigint").repartition(3)
    got = {x["node"]: x["component"] for x in connected_components(df, task_edges=task_edges).collect()}
    assert got == want


def test_stars_of_a_long_path_in_any_order():
    r = np.random.default_rng(4)
    path = r.permutation(5000).astype(np.int64)
    node, low = stars(path[:-1], path[1:])
    assert sorted(node.tolist()) == list(range(1, 5000)) and not low.any()
