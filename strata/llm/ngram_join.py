"""N-gram Jaccard join by token-combination prefixes.

A text's set holds its distinct k-word shingles (A-Z folded; a shorter text is
one shingle, a text without words has the empty set). Two sets link when
100 * |intersection| >= percent * |union|. The work is done on distinct sets;
copies only join the membership.

1. *Sets.* One pass turns each whole text into a sorted array of 64-bit shingle
   hashes, its set id (64 bits, together with the size) and the size.
2. *Shared-token count.* A set of n tokens misses at most tau = n - ceil(percent
   n / 100) of them in a partner. Among the tau + l tokens of smallest hash, at
   least l (for the smaller cut of the two, l of the partner) are then shared
   with it, so a set whose count of tokens seen in any other set stays below
   that bound has no link and goes. Each task sends every distinct token once,
   however often it meets it, so a token of a third of all texts costs one
   entry per task.
3. *Frequencies.* Token counts of the remaining sets, over all of them, in a
   count sketch of fixed width. Order and class of a token are functions of this
   one table; its error can cost time, never a link.
4. *Prefixes and signatures.* Tokens are ordered rarest first. Rare tokens are a
   class each (k = 1); frequent ones fall in sub-classes whose number follows the
   set's size band, indexed by 2-token combinations (k = 2). A prefix grows until
   the sum over classes of max(0, n_c - (k_c - 1)) exceeds tau. If two linked sets
   shared fewer than k_c tokens in each class of the prefix that ends first, that
   set would miss more than tau tokens; so they share a signature. A set signs
   for each band that a partner can be in. One-token sets link only with equal
   sets and need no signature.
5. *Verify.* Members of a signature are chained in order of size (in salted
   runs, then the run heads); chain pairs are verified and give first classes. A
   signature whose members are all in one class is done. The rest connect sets
   to groups in which every pair of compatible size and different class is
   compared exactly, block against block: no pair is emitted, only links.

The classes are the connected components of the verified links.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from strata.llm import flat
from strata.llm.components import connected_components
from strata.session import scratch_path

SAMPLE_SHARE = 0.4
RARE_COUNT = 8
SKETCH_BITS = 22
MAX_FILTER_BITS = 28
BLOCK_ROWS = 256
#: Text behind one bucket of the shared-token count, rows passed along in one bucket, tokens buffered by a task.
BUCKET_BYTES, BUCKET_ROWS, FLUSH_TOKENS = 64 << 20, 1_000_000, 1_000_000
#: Tokens of a bucket that are sorted at once: those of one remainder of their hash.
SLICE_TOKENS = 1_000_000
#: A key with more than one in HOT rows is joined by broadcast; there are fewer than HOT such keys.
HOT = 1000
U64 = np.uint64


def slack(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of an n-token set that a linked partner may lack."""
    return n - -(-percent * n // 100)


def sample_size(n: np.ndarray, percent: int, share: float) -> np.ndarray:
    """Tokens of smallest hash that the shared-token count looks at."""
    tau = slack(n, percent)
    return np.minimum(n, tau + np.maximum(1, (share * n).astype(np.int64) - tau))


def needed(n: np.ndarray, percent: int, share: float) -> np.ndarray:
    """Of these, how many a linked set surely shares with one partner."""
    own = sample_size(n, percent, share) - slack(n, percent)
    low = -(-percent * n // 100)
    best = own
    # The partner's size is between percent of n and n / percent; l grows with it but for rounding.
    for step in (0, 1, 2, 3):
        m = np.minimum(low + step, n)
        best = np.minimum(best, sample_size(m, percent, share) - slack(m, percent))
    return np.maximum(best - 1, (n > 0).astype(np.int64))


def token_sets(text: pa.Array, k: int):
    """(row, sorted distinct shingle hashes, set id) of every text; empty sets have id 0."""
    for first, raw, off in flat.text_chunks(text):
        start, end, word_off = flat.words(raw, off)
        word = flat.segment_hashes(raw, start, end, lower=True)
        gram, gram_off = flat.windows(word, word_off, k)
        for i in range(len(off) - 1):
            x = gram[gram_off[i] : gram_off[i + 1]]
            if not len(x) and word_off[i + 1] > word_off[i]:
                w = word[word_off[i] : word_off[i + 1]]
                x = np.array([len(w)], U64)
                for h in w:
                    x = flat.mix(x * U64(31) + h)
            x = np.sort(x)
            if len(x) > 1:
                x = x[np.concatenate([[True], x[1:] != x[:-1]])]
            total = flat.mix(np.atleast_1d(np.add.reduce(flat.mix(x ^ U64(0x5BF03635)), dtype=U64) + U64(len(x))))[0] if len(x) else U64(0)
            yield first + i, x, np.int64(total.view(np.int64))


_PASS1 = "id {id}, n bigint, sid bigint, bucket int, batch bigint, rem binary, idx binary, sids binary, sizes binary, local binary"


def _first_pass(k: int, percent: int, share: float, buckets: int, schema: pa.Schema):
    def flush(sets: dict, batch: int):
        sids = np.fromiter(sets, np.int64, len(sets))
        n = np.array([s[0] for s in sets.values()], np.int64)
        part = [s[1] for s in sets.values()]
        tok = np.concatenate(part)
        idx = np.repeat(np.arange(len(part), dtype=np.uint32), [len(p) for p in part])
        order = np.argsort(tok, kind="stable")
        tok, idx = tok[order], idx[order]
        new = np.concatenate([[True], tok[1:] != tok[:-1]])
        many = np.add.reduceat(np.ones(len(tok), np.int64), np.flatnonzero(new)) > 1
        group = np.cumsum(new) - 1
        local = np.bincount(idx[many[group]], minlength=len(part))
        tok, idx = tok[new], idx[new] | (many.astype(np.uint32) << np.uint32(31))
        bucket = (((tok >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64)
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in range(buckets):
            lo, hi = cut[b], cut[b + 1]
            if lo < hi:
                used, at = np.unique(idx[lo:hi] & np.uint32(0x7FFFFFFF), return_inverse=True)
                yield {"bucket": b, "batch": batch, "rem": tok[lo:hi].astype(np.uint32).tobytes(),
                       "idx": (at.astype(np.uint32) | (idx[lo:hi] & np.uint32(0x80000000))).tobytes(),
                       "sids": sids[used].tobytes(), "sizes": n[used].astype(np.uint32).tobytes()}
        hit = local > 0
        yield {"bucket": batch % buckets, "batch": batch, "sids": sids[hit].tobytes(), "sizes": n[hit].astype(np.uint32).tobytes(),
               "local": local[hit].astype(np.uint32).tobytes()}

    def run(batches):
        task = TaskContext.get().partitionId() << 24
        sets: dict = {}
        held = number = rows = 0
        for rb in batches:
            ids, n, sid = rb.column(0), np.zeros(rb.num_rows, np.int64), np.zeros(rb.num_rows, np.int64)
            for row, x, s in token_sets(rb.column(1), k):
                n[row], sid[row] = len(x), s
                if len(x) > 1 and s not in sets:
                    take = int(sample_size(np.int64(len(x)), percent, share))
                    sets[s] = (len(x), x[:take].copy())
                    held += take
                if held >= FLUSH_TOKENS:
                    yield pa.RecordBatch.from_pylist(list(flush(sets, task + number)), schema)
                    sets, held, number = {}, 0, number + 1
            blank = {f.name: pa.nulls(rb.num_rows, f.type) for f in schema}
            # These rows only pass along; they are dealt in turn, whatever they hold.
            turn = (TaskContext.get().partitionId() + rows + np.arange(rb.num_rows)) % buckets
            rows += rb.num_rows
            blank |= {"id": ids, "n": pa.array(n), "sid": pa.array(sid), "bucket": pa.array(turn.astype(np.int32))}
            yield pa.RecordBatch.from_arrays([blank[f.name] for f in schema], schema=schema)
        if sets:
            yield pa.RecordBatch.from_pylist(list(flush(sets, task + number)), schema)

    return run


def _sum_equal(sid: np.ndarray, batch: np.ndarray, size: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """One row per (set, batch), counts added."""
    order = np.lexsort((batch, sid))
    sid, batch, size, count = sid[order], batch[order], size[order], count[order]
    new = np.flatnonzero(np.concatenate([[True], (sid[1:] != sid[:-1]) | (batch[1:] != batch[:-1])]))
    return sid[new], batch[new], size[new], np.add.reduceat(count, new)


def _shared_in(rem: list, idx: list, sids: list, sizes: list, batches: list) -> tuple[np.ndarray, ...]:
    """(set, batch, size, tokens seen in another set) out of one bucket's entries, in
    slices of the tokens, so that sorting needs a fraction of the bucket's memory."""
    slices = max(1, -(-sum(map(len, rem)) // SLICE_TOKENS))
    none = np.zeros(0, np.int64)
    total = (none, none, none, none)
    for part in range(slices):
        pick = [np.flatnonzero(r % np.uint32(slices) == part) for r in rem] if slices > 1 else [np.arange(len(r)) for r in rem]
        r = np.concatenate([x[i] for x, i in zip(rem, pick)] or [np.zeros(0, np.uint32)])
        if not len(r):
            continue
        at = [x[i] for x, i in zip(idx, pick)]
        low = [x & np.uint32(0x7FFFFFFF) for x in at]
        s, z = np.concatenate([x[i] for x, i in zip(sids, low)]), np.concatenate([x[i] for x, i in zip(sizes, low)])
        t = np.repeat(np.array(batches, np.int64), [len(i) for i in low])
        multi = np.concatenate(at) >> np.uint32(31) == 1
        order = np.argsort(r, kind="stable")
        r, s, z, t, multi = r[order], s[order], z[order], t[order], multi[order]
        new = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        shared = (np.minimum.reduceat(s, new) != np.maximum.reduceat(s, new)) | np.logical_or.reduceat(multi, new)
        hit = np.repeat(shared, np.diff(np.append(new, len(r)))) & ~multi
        if hit.any():
            more = _sum_equal(s[hit], t[hit], z[hit].astype(np.int64), np.ones(int(hit.sum()), np.int64))
            total = _sum_equal(*(np.concatenate(x) for x in zip(total, more)))
    return total


def _count_shared(schema: pa.Schema):
    """One bucket: membership rows pass; token entries become (set, batch, shared tokens)."""
    def column(table: pa.Table, name: str, kind) -> list[np.ndarray]:
        return [np.frombuffer(x.as_buffer(), kind) for x in table[name]]

    def run(table: pa.Table) -> pa.Table:
        is_member = pa.compute.is_valid(table["n"])
        rest = table.filter(pa.compute.invert(is_member))
        sid, batch, size, count = [], [], [], []
        local = rest.filter(pa.compute.is_valid(rest["local"]))
        for b, s, z, c in zip(local["batch"].to_pylist(), column(local, "sids", np.int64), column(local, "sizes", np.uint32), column(local, "local", np.uint32)):
            sid.append(s)
            batch.append(np.full(len(s), b, np.int64))
            size.append(z.astype(np.int64))
            count.append(c.astype(np.int64))
        posts = rest.filter(pa.compute.is_valid(rest["rem"]))
        found = _shared_in(column(posts, "rem", np.uint32), column(posts, "idx", np.uint32), column(posts, "sids", np.int64), column(posts, "sizes", np.uint32), posts["batch"].to_pylist())
        for whole, part in zip((sid, batch, size, count), found):
            whole.append(part)
        out = [table.filter(is_member).select(["id", "n", "sid"])]
        if sid:
            got = dict(zip(("sid", "batch", "size", "shared"), map(np.concatenate, (sid, batch, size, count))))
            out.append(pa.table({k: pa.array(v, pa.int64()) for k, v in got.items()}))
        whole = []
        for t in out:
            whole.append(pa.table([t[f.name].cast(f.type) if f.name in t.column_names else pa.nulls(t.num_rows, f.type) for f in schema], schema=schema))
        return pa.concat_tables(whole)

    return run


def _bits_of(sids: DataFrame, bits: int) -> np.ndarray:
    """A bit per sid modulo 2**bits; `bits` bounds what reaches the driver."""
    chunk = min(bits, 15)
    rows = (
        sids.select(F.col("sid").bitwiseAND(F.lit((1 << bits) - 1)).alias("pos"))
        .select(F.shiftright("pos", chunk).alias("part"), F.col("pos").bitwiseAND(F.lit((1 << chunk) - 1)).cast("int").alias("at"))
        .groupBy("part").applyInPandas(lambda p: pd.DataFrame({"part": [p["part"].iloc[0]], "bits": [np.packbits(
            np.bincount(p["at"].to_numpy(), minlength=1 << chunk) > 0).tobytes()]}), "part bigint, bits binary")
    ).collect()
    out = np.zeros((1 << (bits - chunk), max(1, (1 << chunk) // 8)), np.uint8)
    for r in rows:
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _second_pass(k: int, bits: int, filled):
    mask = np.int64((1 << bits) - 1)

    def run(batches):
        member = filled.value
        for rb in batches:
            seen: dict = {}
            for _, x, s in token_sets(rb.column(0), k):
                at = int(s & mask)
                if len(x) > 1 and s not in seen and member[at >> 3] >> (7 - (at & 7)) & 1:
                    seen[s] = x.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array([len(v) // 8 for v in seen.values()], pa.int64()),
                                              pa.array(list(seen.values()), pa.binary())], ["sid", "n", "tokens"])

    return run


def _token_counts(bits: int):
    """Each task's counts per sketch cell, cut into rows of 2**14 cells."""
    def run(batches):
        cells = np.zeros(1 << bits, np.uint32)
        some = False
        for rb in batches:
            for x in rb.column(0).to_pylist():
                np.add.at(cells, flat.mix(np.frombuffer(x, U64)) >> U64(64 - bits), 1)
                some = True
        if some:
            parts = cells.reshape(-1, 1 << min(bits, 14))
            keep = np.flatnonzero(parts.any(axis=1))
            for i in keep:
                at = np.flatnonzero(parts[i])
                yield pa.RecordBatch.from_arrays([pa.array([int(i)], pa.int64()), pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                                                  pa.array([parts[i][at].tobytes()], pa.binary())], ["part", "at", "count"])

    return run


def _add_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    cells = np.zeros(1 << 14, np.uint64)
    for at, count in zip(pdf["at"], pdf["count"]):
        cells[np.frombuffer(at, np.uint16)] += np.frombuffer(count, np.uint32)
    return pd.DataFrame({"part": [pdf["part"].iloc[0]], "cells": [np.minimum(cells, 0xFFFFFFFF).astype(np.uint32).tobytes()]})


def signatures(tokens: np.ndarray, count: np.ndarray, percent: int, rare: int) -> np.ndarray:
    """The distinct signatures of one set, given its tokens' counts."""
    n = len(tokens)
    tau = int(slack(np.int64(n), percent))
    order = np.lexsort((tokens, count))
    x, rare_token = tokens[order], count[order] <= rare
    out = []
    for band in sorted({int(-(-percent * n // 100)).bit_length(), n.bit_length(), int(n * 100 // percent).bit_length()}):
        classes = max(1, (1 << band) >> 5)
        cls = np.where(rare_token, -1, (flat.mix(x + U64(band)) % U64(classes)).astype(np.int64))
        common = np.flatnonzero(cls >= 0)
        first = np.zeros(n, bool)
        first[common[np.unique(cls[common], return_index=True)[1]]] = True
        cut = int(np.searchsorted(np.cumsum(~first), tau + 1)) + 1
        px, pc = x[:cut], cls[:cut]
        out.append(px[pc < 0])
        g = np.flatnonzero(pc >= 0)
        g = g[np.lexsort((px[g], pc[g]))]
        for step in range(1, len(g)):
            same = pc[g[:-step]] == pc[g[step:]]
            if not same.any():
                break
            out.append(flat.mix(flat.mix(px[g[:-step]][same] + U64(band)) + px[g[step:]][same]))
    return np.unique(np.concatenate(out))


def _sign(percent: int, rare: int, bits: int, sketch):
    def run(batches):
        cells = sketch.value
        for rb in batches:
            sid, sig = [], []
            for s, x in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                x = np.frombuffer(x, U64)
                g = signatures(x, cells[flat.mix(x) >> U64(64 - bits)], percent, rare)
                sid.append(np.full(len(g), s, np.int64))
                sig.append(g.view(np.int64))
            if sid:
                a, b = np.concatenate(sid), np.concatenate(sig)
                for i in range(0, len(a), 500_000):
                    yield pa.RecordBatch.from_arrays([pa.array(a[i : i + 500_000]), pa.array(b[i : i + 500_000])], ["sid", "sig"])

    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verify(percent: int):
    def run(batches):
        for rb in batches:
            keep = [_linked(np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64), percent) for x, y in zip(rb.column(2), rb.column(3))]
            yield pa.RecordBatch.from_arrays([rb.column(0).filter(pa.array(keep, pa.bool_())), rb.column(1).filter(pa.array(keep, pa.bool_()))], ["a", "b"])

    return run


def _compare_blocks(percent: int):
    """All pairs of one block, or of two blocks, that are of different classes: an
    inverted index over the left block counts the intersections of each right
    set; links that join classes not yet joined here are returned."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["sid", "side"])
        left = pdf if pdf["same"].iloc[0] else pdf[pdf["side"] == 0]
        right = pdf if pdf["same"].iloc[0] else pdf[pdf["side"] == 1]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        sets = [np.frombuffer(x, U64) for x in left["tokens"]]
        size = np.array([len(x) for x in sets])
        tok, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        order = np.argsort(tok, kind="stable")
        tok, owner = tok[order], owner[order]
        sid, label = left["sid"].to_numpy(), left["label"].to_numpy()
        root: dict = {}

        def find(z):
            while root.get(z, z) != z:
                z = root[z]
            return z

        a, b = [], []
        for s, lab, x in zip(right["sid"], right["label"], right["tokens"]):
            x = np.frombuffer(x, U64)
            lo, hi = np.searchsorted(tok, x), np.searchsorted(tok, x, side="right")
            run_len = hi - lo
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(run_len)[:-1]]), run_len) + np.arange(run_len.sum())
            both = np.bincount(owner[at], minlength=len(sets))
            for i in np.flatnonzero((100 * both >= percent * (size + len(x) - both)) & (label != lab)):
                p, q = find(label[i]), find(lab)
                if p != q:
                    root[max(p, q)] = min(p, q)
                    a.append(sid[i])
                    b.append(s)
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return run


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75,
                    share: float = SAMPLE_SHARE, rare: int = RARE_COUNT, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """One row per row of `docs`: its id, `n_shingles`, `set_id`, `component_id`
    (smallest id reachable over links), `component_size` (rows in it).

    A row with a null or word-less text is a component of its own, as is a row
    whose component holds only null ids (its component_id is null). Repeated
    rows share a set. An empty table gives an empty result. Other columns of
    `docs` are not read, whatever their names.
    """
    spark: SparkSession = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    volume, rows = src.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    buckets = max(parts, math.ceil((volume or 0) / BUCKET_BYTES), math.ceil(rows / BUCKET_ROWS))

    pass1 = StructType.fromDDL(_PASS1.format(id=id_type.simpleString()))
    counted = StructType.fromDDL(f"id {id_type.simpleString()}, n bigint, sid bigint, batch bigint, size bigint, shared bigint")
    base = scratch_path(spark, "ngram-join")
    (
        src.mapInArrow(_first_pass(k, percent, share, buckets, to_arrow_schema(pass1)), pass1)
        .groupBy("bucket").applyInArrow(_count_shared(to_arrow_schema(counted)), counted)
        .write.parquet(f"{base}/sets")
    )
    first = spark.read.parquet(f"{base}/sets")
    members = first.where(F.col("n").isNotNull()).select("id", "n", "sid")
    survivors = (
        first.where(F.col("shared").isNotNull()).groupBy("sid", "batch")
        .agg(F.sum("shared").alias("shared"), F.first("size").alias("size"))
        .where(F.col("shared") >= _needed_column("size", percent, share)).select("sid").distinct().checkpoint(eager=True)
    )
    count = survivors.count()
    bits = min(MAX_FILTER_BITS, max(10, (16 * count).bit_length()))
    filled = spark.sparkContext.broadcast(_bits_of(survivors, bits))
    # Sets that passed the bit table; the exact semi-join drops its false positives, the grouping copies met by several tasks.
    (
        src.select("text").mapInArrow(_second_pass(k, bits, filled), "sid bigint, n bigint, tokens binary")
        .join(survivors, "sid", "left_semi").groupBy("sid").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
        .write.parquet(f"{base}/candidates")
    )
    cand = spark.read.parquet(f"{base}/candidates")
    cells = np.zeros((1 << (sketch_bits - 14), 1 << 14), np.uint32)
    for r in cand.select("tokens").mapInArrow(_token_counts(sketch_bits), "part bigint, at binary, count binary").groupBy("part").applyInPandas(
            _add_counts, "part bigint, cells binary").collect():
        cells[r["part"]] = np.frombuffer(r["cells"], np.uint32)
    sketch = spark.sparkContext.broadcast(cells.reshape(-1))
    cand.select("sid", "tokens").mapInArrow(_sign(percent, rare, sketch_bits, sketch), "sid bigint, sig bigint").join(
        cand.select("sid", "n"), "sid").write.parquet(f"{base}/signatures")
    signed = spark.read.parquet(f"{base}/signatures")

    by_size = [F.col("n"), F.col("sid")]
    run = Window.partitionBy("sig", "salt").orderBy(*by_size)
    chained = signed.withColumn("salt", F.pmod(F.xxhash64("sid"), F.lit(16))).withColumn("other", F.lag("sid").over(run)).withColumn("m", F.lag("n").over(run))
    heads = chained.where(F.col("other").isNull())
    over = Window.partitionBy("sig").orderBy(*by_size)
    heads = heads.withColumn("other", F.lag("sid").over(over)).withColumn("m", F.lag("n").over(over))
    pairs = (
        chained.where(F.col("other").isNotNull()).unionByName(heads.where(F.col("other").isNotNull()))
        .where(F.col("m") * 100 >= F.col("n") * percent)
        .select(F.least("sid", "other").alias("a"), F.greatest("sid", "other").alias("b")).distinct()
    )
    tokens = cand.select("sid", "tokens")
    links = (
        pairs.join(tokens.withColumnsRenamed({"sid": "a", "tokens": "ta"}), "a").join(tokens.withColumnsRenamed({"sid": "b", "tokens": "tb"}), "b")
        .select("a", "b", "ta", "tb").mapInArrow(_verify(percent), "a bigint, b bigint").checkpoint(eager=True)
    )
    label = connected_components(links).checkpoint(eager=True)

    # Signatures whose members are still in several classes tie sets to groups that must be compared.
    open_rows = signed.join(label.withColumnRenamed("node", "sid"), "sid", "left").select("sig", "sid", F.coalesce("component", "sid").alias("label"))
    many = open_rows.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("sid").alias("hub")).where("lo < hi").select("sig", "hub")
    tied = signed.join(many, "sig").select(F.col("sid").alias("a"), F.col("hub").alias("b")).distinct()
    group = connected_components(tied)
    step = math.log(100 / percent)
    rows = (
        group.withColumnRenamed("node", "sid").join(cand, "sid").join(label.withColumnRenamed("node", "sid").withColumnRenamed("component", "label"), "sid", "left")
        .select("component", "sid", "tokens", F.coalesce("label", "sid").alias("label"), F.floor(F.log(F.col("n") + 0.0) / step).alias("band"))
    )
    blocks = group.withColumnRenamed("node", "sid").join(cand.select("sid", "n"), "sid").groupBy(
        "component", F.floor(F.log(F.col("n") + 0.0) / step).alias("band")).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"))
    near = blocks.select("component", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), F.col("band").alias("other_band"), F.col("blocks").alias("other_blocks"))
    units = (
        rows.join(blocks, ["component", "band"]).withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")))
        .join(near, ["component", "band"]).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("other_blocks") - 1)))
        .withColumn("mine", F.struct("band", "block")).withColumn("theirs", F.struct(F.col("other_band").alias("band"), F.col("other").alias("block")))
        .select("component", F.least("mine", "theirs").alias("p"), F.greatest("mine", "theirs").alias("q"),
                F.when(F.col("mine") <= F.col("theirs"), 0).otherwise(1).alias("side"), (F.col("mine") == F.col("theirs")).alias("same"), "sid", "label", "tokens")
    )
    more = units.groupBy("component", "p", "q").applyInPandas(_compare_blocks(percent), "a bigint, b bigint").checkpoint(eager=True)
    final = connected_components(links.unionByName(more))
    return _membership(members, final, base)


def _needed_column(size: str, percent: int, share: float):
    """`needed` as a column: the smallest assured share over partner sizes, less one for rounding."""
    def assured(m):
        tau = m - F.ceil(m * percent / 100)
        return F.least(m, tau + F.greatest(F.lit(1), F.floor(m * share) - tau)) - tau

    n = F.col(size)
    low = F.ceil(n * percent / 100)
    best = F.least(assured(n), *[assured(F.least(low + i, n)) for i in range(4)])
    return F.greatest(best - 1, F.lit(1))


def _membership(members: DataFrame, classes: DataFrame, base: str) -> DataFrame:
    """The answer is found per distinct set (known by id and size) and stored; rows
    then look it up, those of hot sets in a broadcast of fewer than HOT entries."""
    spark = members.sparkSession
    # An empty set links with nothing, not even another one: its row stands for itself.
    lone = members.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("sid").alias("set_id"), F.col("id").alias("component_id"), F.lit(1).cast("bigint").alias("component_size"))
    full = members.where("n > 0")
    sets = full.groupBy("sid", "n").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")).join(classes.withColumnRenamed("node", "sid"), "sid", "left")
    # The size separates sets outside any link only.
    sets = sets.withColumn("root", F.coalesce("component", "sid")).withColumn("apart", F.when(F.col("component").isNull(), F.col("n")).otherwise(0)).drop("component")
    sets.write.parquet(f"{base}/distinct")
    sets = spark.read.schema(sets.schema).parquet(f"{base}/distinct")
    groups = sets.groupBy("root", "apart").agg(F.min("least").alias("component_id"), F.sum("rows").alias("component_size"), F.count(F.lit(1)).alias("sets"))
    groups.write.parquet(f"{base}/groups")
    groups = spark.read.schema(groups.schema).parquet(f"{base}/groups")
    known = _join_hot(sets.drop("least"), groups, ["root", "apart"], "sets").select("sid", "n", "component_id", "component_size", "rows")
    known.write.parquet(f"{base}/known")
    known = spark.read.schema(known.schema).parquet(f"{base}/known")
    found = _join_hot(full, known, ["sid", "n"], "rows")
    return found.select("id", F.col("n").alias("n_shingles"), F.col("sid").alias("set_id"), "component_id", "component_size").unionByName(lone)


def _join_hot(big: DataFrame, small: DataFrame, on: list[str], weight: str) -> DataFrame:
    """`big` with the columns of `small` (one row per key, every key there); `weight`
    is the number of rows of `big` that a key has."""
    total = small.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * HOT > total
    hot, cold = F.broadcast(small.where(is_hot).drop(weight)), small.where(~is_hot).drop(weight)
    return big.join(hot, on).unionByName(big.join(F.broadcast(small.where(is_hot).select(*on)), on, "left_anti").join(cold, on))


#: The same rows from shingle texts; for distinct, non-null doc_ids.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS hits FROM g x JOIN g y USING (s) WHERE x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM b JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * hits >= 75 * (p.n + q.n - hits)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, count(*) OVER (PARTITION BY component_id) AS component_size FROM c LEFT JOIN n USING (doc_id)
"""
