import hashlib
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import fingerprint
from strata.llm.queries import QUERIES
from conftest import WORD

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p if isinstance(p, bytes) else struct.pack("<i", p), seed)
    return signed(seed)


def shingles(text):
    words = [w.encode() for w in WORD.findall(text.lower())]
    return {chain(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_print(text, bins=fingerprint.BINS, bits=fingerprint.BITS):
    least = {}
    for h in shingles(text):
        j = (h >> (64 - (bins.bit_length() - 1))) + bins // 2
        least[j] = min(h, least.get(j, h))
    if not least:
        return []
    out = []
    for j in range(bins):
        probes = [j] + [chain([j, t]) % bins for t in range(fingerprint.PROBES)]
        x = next((least[p] for p in probes if p in least), None)
        out.append((least[min(least, key=lambda b: chain([j, b]))] if x is None else x) & ((1 << bits) - 1))
    return out


def brute_like(a, b, bits=fingerprint.BITS):
    if not a or not b:
        return float(not a and not b)
    share = sum(x == y for x, y in zip(a, b)) / len(a)
    return max(0.0, (share - 2.0**-bits) / (1 - 2.0**-bits))


def brute(rows):
    """rows of (doc_id, text) with distinct ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = map(brute_print, (t, edited, after))
        text = lambda p: "".join(f"{x:X}" for x in p)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(a), text(b), pytest.approx(brute_like(a, b)), pytest.approx(brute_like(a, c))))
    return out


def prints(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))


def test_equals_brute_force(spark, documents):
    rng = random.Random(2)
    vocab = ["alpha", "Beta", "été", "中文", "x", "delta🎉", "ÉCOLE"]
    rows = [(i, rng.choice(["", " ", "\t"]) + " ".join(rng.choices(vocab, k=rng.choice([0, 1, 3, 4, 5, 6, 40, 300])))) for i in rng.sample(range(-50, 500), 40)]
    rows += [(None, "null id one two three four five"), (1000, None), (1001, "  \n\t "), (1002, "a b c d e")]
    assert prints(fingerprint.fingerprint_edits(documents(*rows))) == brute(rows)


def test_whole_small_table_estimates_the_true_likeness(spark, sf_small):
    got = prints(QUERIES["op13_fingerprints"](spark, sf_small))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    ids = sorted(texts)
    assert [g[0] for g in got] == ids
    errors = []
    for g, after in zip(got, ids[1:] + ids[:1]):
        t = texts[g[0]] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + (texts[after] or "")[:half]
        assert g[1:3] == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b = shingles(t), shingles(edited)
        errors.append(g[5] - len(a & b) / max(1, len(a | b)))
    assert max(map(abs, errors)) < 0.2 and abs(sum(errors) / len(errors)) < 0.02


def test_other_widths(spark, documents):
    rows = [(i, " ".join(f"w{(i * 7 + j) % 90}" for j in range(30 + i))) for i in range(8)]
    for bins, bits in [(64, 1), (128, 8), (64, 16)]:
        df = fingerprint.with_fingerprint(documents(*rows).select("doc_id", "text"), "text", "fp", bins, bits)
        for r in df.collect():
            got = int("".join(f"{x & (1 << 64) - 1:016x}" for x in r["fp"]), 16)
            want = 0
            for x in brute_print(dict(rows)[r["doc_id"]], bins, bits):
                want = want << bits | x
            assert got == want
        a, b = (fingerprint.with_fingerprint(documents(x).select("text"), "text", n, bits=bits, bins=bins).drop("text") for x, n in ((rows[0], "a"), (rows[1], "b")))
        near = a.crossJoin(b).select(fingerprint.likeness(F.col("a"), F.col("b"), bins, bits)).first()[0]
        assert near == pytest.approx(brute_like(brute_print(rows[0][1], bins, bits), brute_print(rows[1][1], bins, bits), bits))


def test_repeated_ids_and_rows(spark, documents):
    rows = [(1, "one two three four five six")] * 3 + [(1, "other text of the same id here")] + [(2, "last of all these few documents")]
    got = prints(fingerprint.fingerprint_edits(documents(*rows)))
    assert len(got) == 5 and len(set(got)) == 3
    assert len({r[3] for r in got}) == 3


def test_a_document_repeated_more_often_than_one_run(spark, documents):
    df = documents((1, "a b c d e f")).crossJoin(spark.range(10_000).select(F.col("id").alias("copies"))).unionByName(documents((2, "x y")), allowMissingColumns=True)
    got = fingerprint.fingerprint_edits(df).groupBy(*COLUMNS).count().collect()
    assert sorted(r["count"] for r in got) == [1, 10_000]


def test_single_empty_and_long(spark, documents):
    only = prints(fingerprint.fingerprint_edits(documents((5, "ab cd"))))
    assert only == brute([(5, "ab cd")])
    assert prints(fingerprint.fingerprint_edits(documents())) == []
    long = " ".join(f"word{i}" for i in range(200_000))
    rows = [(1, long), (2, long + " end")]
    got = prints(fingerprint.fingerprint_edits(documents(*rows, extra=", h bigint, next string, part int")))
    assert got == brute(rows) and got[0][6] > 0.95
