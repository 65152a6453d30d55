import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import prefix_trie
from strata.session import scratch_path
from conftest import WORD

TURNS = "conv_id bigint, turn bigint, role string, text string"
ROOT_HASH = hashlib.sha256(b"").hexdigest()


def brute(rows):
    """Every node from whole prefixes; subtrees by looking at every other node."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0, role or "", text or ""), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + ts[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].add(c)
        ends[seq].append(c)
    children = defaultdict(int)
    for s in members:
        if s:
            children[s[:-1]] += 1
    out = set()
    for s, m in members.items():
        below = [u for u in members if u[: len(s)] == s]
        out.add((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), children[s], sum(not children[u] for u in below),
                 sum((len(members[u]) - 1) * len(WORD.findall(u[-1][1] if u else "")) for u in below),
                 hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest()))
    return out


def nodes(spark, rows, extra=None, **how):
    df = spark.createDataFrame(rows, TURNS)
    for c in extra or []:
        df = df.withColumn(c, F.lit("x"))
    turns = prefix_trie.numbered_turns(df, scratch_path(spark, "test-trie"))
    got = prefix_trie.prefix_trie(prefix_trie.lend_heads(turns), **how)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got))
    return set(got)


def some_conversations(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 130), n):
        for turn in range(rng.randrange(1, 7)):
            rows.append((c, rng.choice([turn, None]), rng.choice(["user", None, ""]), rng.choice(["a b", "a  b", "", None, "word", "été\tx"])))
    return rows + rows[:3]


def test_equals_brute_force_over_several_blocks_and_chunks(spark):
    rows = some_conversations(1)
    assert nodes(spark, rows, block=8, chunk_turns=2) == brute(rows)


def test_one_conversation_holding_a_third_of_all_rows_and_a_wide_root(spark):
    rows = [(7, i, "user", f"t{i} x y") for i in range(300)] + [(c, 0, "user", f"start {c}") for c in range(100, 400)] + [(c, 0, "u", "same") for c in range(400, 700)]
    assert nodes(spark, rows, block=64, chunk_turns=16) == brute(rows)


def test_extra_columns_long_texts_and_equal_rows(spark):
    rows = [(20, 1, "user", "w " * 50_000), (21, 1, "user", "w " * 50_000), (20, 1, "user", "w " * 50_000), (None, 1, "user", "x")]
    assert nodes(spark, rows, extra=["no", "pos", "part", "depth", "k1"]) == brute(rows)


def test_empty_and_turnless(spark):
    assert nodes(spark, []) == set()
    # 4 lends two turns of an absent conversation's and keeps nothing of its single own turn.
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 2)
    assert nodes(spark, [(lone, 0, "user", "hi")]) == {(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())}


@pytest.mark.parametrize("block", [2, 1000])
def test_list_ranks_of_a_shuffled_list(spark, block):
    n = 60
    rng = random.Random(block)
    order = list(range(n))
    rng.shuffle(order)
    weight = [rng.randrange(10) for _ in range(n)]
    after = dict(zip(order, order[1:] + [-1]))
    items = spark.createDataFrame([(i, i, after[i], 1, weight[i], i) for i in range(n)], prefix_trie.LIST)
    got = {r["item"]: (r["steps"], r["leaves"], r["saved"]) for r in prefix_trie.list_ranks(items, scratch_path(spark, "test-list"), block).collect()}
    assert got == {x: (k, sum(weight[y] for y in order[:k]), sum(order[:k])) for k, x in enumerate(order)}
