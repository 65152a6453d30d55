import collections

from conftest import WORD
from pyspark.sql import functions as F

from strata.llm import mixing

SCHEMA = "doc_id bigint, source string, size bigint, rid bigint, mix_copies int"


def levels(sizes):
    """Targets by repeated resharing."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, rest = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        free -= over
    return target


def check(df, rows):
    got = df.collect()
    assert len(got) == len(rows)
    sizes, taken, biggest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in got:
        n = r["size"] or 0
        sizes[r["source"]] += n
        taken[r["source"]] += n * r["mix_copies"]
        biggest[r["source"]] = max(biggest[r["source"]], n)
        assert 0 <= r["mix_copies"] <= 2
    want = levels(sizes)
    for r in got:
        assert abs(r["mix_target"] - want[r["source"]]) <= 1e-9 * max(1, want[r["source"]]) and r["mix_source_size"] == sizes[r["source"]]
    for s, t in want.items():
        # p is rounded down to 2**-20; beyond that the masses are exact.
        assert abs(taken[s] - t) <= biggest[s] + sizes[s] / 2**20 + 1, (s, taken[s], t)


def rows():
    out = [(i, f"s{i % 7}", (i * 37) % 900 + 1, 1, 2) for i in range(3000)]
    out += [(10_000 + i, "hot", (i * 13) % 50, 1, 2) for i in range(3000)]
    out += [(None, None, 10, 1, 2)] * 300 + [(5, "é", None, 1, 2), (6, "Z", 0, 1, 2), (7, "", 3, 1, 2)]
    return out


def test_targets_words_and_reruns(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    mixed = mixing.mix(df).withColumnRenamed("rid", "rid").cache()
    check(mixed, data)
    assert "rid" in mixed.columns and mixed.columns.count("mix_copies") == 1
    key = lambda d: sorted((str(r["doc_id"]), r["source"] or "", r["mix_copies"]) for r in d.where("source is not null").collect())
    assert key(mixed) == key(mixing.mix(df.repartition(9)))


def test_small_tables(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    check(mixing.mix(spark.createDataFrame([(1, "a", 10, 1, 2)], SCHEMA)), [0])
    zero = mixing.mix(spark.createDataFrame([(1, "a", 0, 1, 2), (2, None, None, 1, 2)], SCHEMA)).collect()
    assert [r["mix_target"] for r in zero] == [0.0, 0.0]


def test_word_counts(documents):
    texts = [None, "", " \n", "a", "a\tb\x0bc d", "a b é\x85f"]
    got = documents(*enumerate(texts)).select("doc_id", mixing.word_count(F.col("text")).alias("n")).orderBy("doc_id").collect()
    assert [r["n"] for r in got] == [len(WORD.findall(t or "")) for t in texts]


def test_every_document_has_its_share(spark):
    # One source of equal documents at rate 1.5: over many seeds each document is taken half the time more.
    df = spark.createDataFrame([(i, "a", 4, 0, 0) for i in range(40)], SCHEMA).coalesce(1)
    total = collections.Counter()
    for seed in range(6):
        got = mixing.mix(df, seed=seed).collect()
        assert sum(r["mix_copies"] for r in got) == 60
        total.update({r["doc_id"]: r["mix_copies"] for r in got})
    assert len(set(total.values())) > 1 and all(6 <= total[i] <= 12 for i in range(40))
