"""Conversation prefix trie by the Euler-tour technique.

Conversations that begin alike share the nodes of a trie: a depth-d node is a
distinct sequence of first d turns. A prefix is known by its depth and two
rolling sums of 64-bit hashes of (position, role, text); it is named by its
smallest member, and (conv_id, depth) names a node uniquely.

1. *Prefixes.* Positions come from range partitions, rolling sums from chunks of
   turns and chunk totals, so a conversation of any length is spread over tasks.
2. *Arcs.* A node has an enter and an exit arc. After enter comes the first
   child's enter, or the node's own exit; after exit the next sibling's enter, or
   the parent's exit. First children are a minimum per parent; next siblings come
   from range partitions, so a parent of a third of all nodes is no single task.
3. *List ranking.* Arcs are numbered along (conv_id, depth), which keeps most
   steps of the tour near each other. Each block of BLOCK arcs contracts its
   local chains by pointer jumping; only chain heads go on. Heads drawn by a coin
   then absorb an undrawn successor, which removes a quarter of them whatever the
   order. The rest is numbered again, until one head is left; going back, each
   level adds its offsets to the head's rank.
4. *Sums.* Ranks are exclusive prefix sums of (arcs, leaves, saved words) along
   the tour. What lies between a node's arcs is its subtree.

No step holds a group in memory. The ids of a node's ending conversations are
hashed as a stream: SHA-256 is sequential by nature, so the ids (8 bytes each) of
one node pass through one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from strata.functions import ordering
from strata.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
#: Turns per chunk of the rolling sums; arcs per block of the list ranking.
CHUNK_TURNS, BLOCK = 4096, 1 << 12
SUMS = ["steps", "leaves", "saved"]
LIST = StructType([StructField(c, LongType()) for c in ("item", "place", "next", *SUMS)])
CHAINS = StructType([StructField(c, LongType()) for c in ("item", "head", "next", *(f"{p}_{s}" for p in ("off", "all") for s in SUMS))])


def numbered_turns(conversations: DataFrame, base: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos from 1, t1, t2 hashes of the turn, words) of every turn.

    A conversation's turns are ordered by turn (null first), then role, then text
    (null as empty); repeated rows are repeated turns. Rows without a conversation
    id belong to no conversation and are left out.
    """
    src = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    stored = ordering.in_parts(src, [F.col("conv_id"), *order], f"{base}/turns")
    return ordering.positions(stored, ["conv_id"], order).select(
        "conv_id", F.col("pos").cast("bigint").alias("pos"), F.xxhash64(F.lit(1), "role", "text").alias("t1"), F.xxhash64(F.lit(2), "role", "text").alias("t2"),
        F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("words"))


def lend_heads(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Rebuilds every conversation c: the first h turns of conversation c - c % every
    (none if absent), then its own turns after its first h; h = crc32(c) % most.
    Returns the turns with new `pos` and `len`; a conversation that is left without
    turns has one row with `pos` 0."""
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("lender"))
    lenders = convs.select(F.col("conv_id").alias("lender"), F.col("n").alias("has"))
    convs = convs.join(lenders, "lender", "left").withColumn("m", F.least("h", F.coalesce("has", F.lit(0))))
    convs = convs.withColumn("len", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).select("conv_id", "lender", "h", "m", "len")
    lent = turns.where((F.col("pos") < most) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "lender").join(convs, "lender").where(F.col("pos") <= F.col("h"))
    own = turns.join(convs, "conv_id").where(F.col("pos") > F.col("h")).withColumn("pos", F.col("pos") - F.col("h") + F.col("m"))
    columns = ["conv_id", "pos", "t1", "t2", "words", "len"]
    bare = convs.where("len = 0").select("conv_id", *[F.lit(0).cast("bigint").alias(c) for c in columns[1:]])
    return lent.select(*columns).unionByName(own.select(*columns)).unionByName(bare)


def with_prefixes(rebuilt: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """Adds the prefix keys `k1`, `k2` of every turn and `p1`, `p2` of the prefix before it."""
    def wide(c: Column) -> Column:
        return c.cast("decimal(38,0)")

    rows = rebuilt.withColumn("chunk", F.floor((F.col("pos") - 1) / chunk_turns))
    rows = rows.withColumn("a", wide(F.when(F.col("pos") > 0, F.xxhash64("pos", "t1")).otherwise(0))).withColumn("b", wide(F.when(F.col("pos") > 0, F.xxhash64("t2", "pos")).otherwise(0)))
    over = Window.partitionBy("conv_id").orderBy("chunk")
    totals = rows.groupBy("conv_id", "chunk").agg(F.sum("a").alias("ta"), F.sum("b").alias("tb")).select(
        "conv_id", "chunk", (F.sum("ta").over(over) - F.col("ta")).alias("ta"), (F.sum("tb").over(over) - F.col("tb")).alias("tb"))
    upto = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("k1", F.sum("a").over(upto)).withColumn("k2", F.sum("b").over(upto)).join(totals, ["conv_id", "chunk"])
    rows = rows.withColumn("k1", wide(F.col("k1") + F.col("ta"))).withColumn("k2", wide(F.col("k2") + F.col("tb")))
    return rows.select("conv_id", F.col("pos").alias("depth"), "len", "words", "k1", "k2", wide(F.col("k1") - F.col("a")).alias("p1"), wide(F.col("k2") - F.col("b")).alias("p2"))


def _chains(table: pa.Table) -> pa.Table:
    """One block: every item's chain head and the sums from the head up to it; heads
    also get the item after their chain and the chain's sums."""
    table = table.combine_chunks().sort_by("item")
    item, nxt = table["item"].to_numpy(), table["next"].to_numpy()
    n = len(item)
    at = np.minimum(np.searchsorted(item, nxt), n - 1)
    local = item[at] == nxt
    # Pointers to the item before; a head points at itself and adds nothing.
    up = np.arange(n)
    up[at[local]] = np.flatnonzero(local)
    own = [table[c].to_numpy() for c in SUMS]
    off = [np.zeros(n, np.int64) for _ in SUMS]
    for o, w in zip(off, own):
        o[at[local]] = w[local]
    while True:
        further = up[up]
        if np.array_equal(further, up):
            break
        for o in off:
            o += o[up]
        up = further
    tail = np.flatnonzero(~local)
    end, whole = np.full(n, -1, np.int64), [np.zeros(n, np.int64) for _ in SUMS]
    end[up[tail]] = nxt[tail]
    for t, o, w in zip(whole, off, own):
        t[up[tail]] = o[tail] + w[tail]
    return pa.table([pa.array(x) for x in (item, item[up], end, *off, *whole)], schema=pa.schema([(f.name, pa.int64()) for f in CHAINS]))


def list_ranks(items: DataFrame, base: str, block: int = BLOCK) -> DataFrame:
    """Exclusive prefix sums along one linked list: (item, steps, leaves, saved).

    `items` has item, place (a dense number from 0; neighbours in the list are best
    near in it), next (-1 at the end), steps, leaves, saved. Every level is stored.
    """
    spark = items.sparkSession
    levels: list[DataFrame] = []
    while True:
        path = f"{base}/level-{len(levels)}"
        items.groupBy(F.floor(F.col("place") / block).alias("block")).applyInArrow(_chains, CHAINS).write.parquet(path)
        level = spark.read.parquet(path)
        levels.append(level)
        heads = level.where("item = head").select("item", "next", *[F.col(f"all_{s}").alias(s) for s in SUMS])
        if heads.count() <= 1:
            break
        # A head with a drawn coin absorbs a successor without one; of two successive removals there is none.
        drawn = (F.xxhash64(F.lit(len(levels)), "item") % 2 == 0)
        first = heads.where(drawn)
        after = heads.where(~drawn).select(F.col("item").alias("next"), F.col("next").alias("then"), *[F.col(s).alias(f"more_{s}") for s in SUMS])
        joined = first.join(after, "next", "left")
        merged = joined.select("item", F.coalesce("then", "next").alias("next"), *[(F.col(s) + F.coalesce(f"more_{s}", F.lit(0))).alias(s) for s in SUMS],
                               F.when(F.col("then").isNotNull(), F.col("next")).alias("gone"), *[F.col(s).alias(f"off_{s}") for s in SUMS])
        path = f"{base}/spliced-{len(levels)}"
        merged.write.parquet(path)
        merged = spark.read.parquet(path)
        gone = merged.where("gone is not null").select(F.col("gone").alias("item"), F.col("item").alias("head"), *[f"off_{s}" for s in SUMS])
        stay = merged.select("item", "next", *SUMS).unionByName(heads.where(~drawn).join(gone, "item", "left_anti"))
        kept = stay.select("item", F.col("item").alias("head"), *[F.lit(0).cast("bigint").alias(f"off_{s}") for s in SUMS])
        levels.append(kept.unionByName(gone))
        stored = ordering.in_parts(stay, [F.col("item")], f"{base}/list-{len(levels)}")
        items = ordering.positions(stored, [], [F.col("item")], "place").withColumn("place", F.col("place") - 1)
    ranks = levels.pop().select("item", *[F.col(f"off_{s}").alias(s) for s in SUMS])
    while levels:
        level = levels.pop().select("item", "head", *[f"off_{s}" for s in SUMS])
        ranks = level.join(ranks.withColumnRenamed("item", "head"), "head").select("item", *[(F.col(s) + F.col(f"off_{s}")).alias(s) for s in SUMS])
    ranks.write.parquet(f"{base}/ranks")
    return spark.read.parquet(f"{base}/ranks")


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each run of equal `no`; rows come sorted."""
    open_no, state = None, None
    for rb in batches:
        no, conv = rb.column(0).to_numpy(), rb.column(1).to_numpy()
        cut = np.concatenate([[0], np.flatnonzero(no[1:] != no[:-1]) + 1, [len(no)]]) if len(no) else np.zeros(1, np.int64)
        done: list[tuple[int, str]] = []
        for a, b in zip(cut[:-1], cut[1:]):
            ids = ",".join(map(str, conv[a:b].tolist())).encode()
            if state is not None and no[a] == open_no:
                state.update(b"," + ids)
            else:
                if state is not None:
                    done.append((open_no, state.hexdigest()))
                open_no, state = int(no[a]), hashlib.sha256(ids)
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.string())], ["no", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([open_no], pa.int64()), pa.array([state.hexdigest()])], ["no", "ends_sha256"])


def prefix_trie(rebuilt: DataFrame, block: int = BLOCK, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """One row per trie node: conv_id (smallest member), depth, parent_conv_id (null at
    the root), n_convs (members), n_children, n_leaves (childless nodes in the subtree,
    itself included), saved_tokens (over the subtree, (members - 1) times the words of
    the last turn), ends_sha256 (hash of the comma-joined ids that end here).

    `rebuilt` has conv_id, pos (1, 2, ... without gaps; 0 for a conversation without
    turns), t1, t2, words, len, as `numbered_turns` and `lend_heads` give them. An
    empty table gives an empty result.
    """
    spark = rebuilt.sparkSession
    base = scratch_path(spark, "prefix-trie")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    key = ["depth", "k1", "k2"]
    prefixes = stored(with_prefixes(rebuilt, chunk_turns), "prefixes")
    zero = F.lit(0).cast("decimal(38,0)")
    # Every conversation's last prefix stands for it at the root.
    root = prefixes.where("depth = len").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.lit(0).cast("bigint").alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", F.lit(0).cast("bigint").alias("words"), zero.alias("p1"), zero.alias("p2"))
    nodes = prefixes.where("depth > 0").groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    order = [F.col("conv_id"), F.col("depth")]
    placed = ordering.positions(ordering.in_parts(nodes.unionByName(root), order, f"{base}/nodes"), [], order, "no")
    nodes = stored(placed.withColumn("no", F.col("no").cast("bigint") - 1).drop("part"), "numbered")

    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("no").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where("depth > 0").select("no", "depth", "p1", "p2")
    family = ordering.in_parts(below.join(above, ["depth", "p1", "p2"]).select("no", "parent", "parent_conv_id"), [F.col("parent"), F.col("no")], f"{base}/family")
    children = family.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"), F.min("no").alias("first")).withColumnRenamed("parent", "no")
    siblings = ordering.next_in_group(family, ["parent"], "no", "sibling").drop("part")
    tree = stored(nodes.join(children, "no", "left").join(siblings, "no", "left").select(
        "no", *key, "conv_id", "parent", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "first", "sibling",
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "tree")

    enter = tree.select((F.col("no") * 2).alias("item"), F.coalesce(F.col("first") * 2, F.col("no") * 2 + 1).alias("next"), F.lit(1).cast("bigint").alias("steps"),
                        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("leaves"), "saved")
    none = F.lit(0).cast("bigint")
    leave = tree.select((F.col("no") * 2 + 1).alias("item"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1, F.lit(-1)).alias("next"),
                        F.lit(1).cast("bigint").alias("steps"), none.alias("leaves"), none.alias("saved"))
    arcs = enter.unionByName(leave).withColumn("place", F.col("item"))
    ranks = list_ranks(arcs.select(*[f.name for f in LIST]), base, block)
    spans = ranks.groupBy(F.shiftright("item", 1).alias("no")).agg(
        *[(F.max(F.when(F.col("item") % 2 == 1, F.col(s))) - F.max(F.when(F.col("item") % 2 == 0, F.col(s)))).alias(s) for s in ("leaves", "saved")])

    ends = prefixes.where("depth = len").select("conv_id", *key).join(tree.select("no", *key), key).select("no", "conv_id")
    ends = ends.repartition("no").sortWithinPartitions("no", "conv_id").mapInArrow(_hash_ids, "no bigint, ends_sha256 string")
    return tree.drop("saved").join(spans, "no").join(ends, "no", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


#: The same rows from whole prefixes as text: sums over each node's own prefixes stand for its subtree.
ORACLE = r"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS lender,
    xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT),
      lambda crc, b: list_reduce([xor(crc, b)] || range(8), lambda a, j: xor(a // 2, (a % 2) * 3988292384))), 4294967295) % 4 AS h
  FROM o GROUP BY conv_id),
l AS (SELECT a.*, least(a.h, coalesce(b.n, 0)) AS m FROM c a LEFT JOIN c b ON b.conv_id = a.lender),
r AS (SELECT l.conv_id, o.pos, o.role, o.text FROM l JOIN o ON o.conv_id = l.lender AND o.pos <= l.h
  UNION ALL SELECT l.conv_id, o.pos - l.h + l.m, o.role, o.text FROM l JOIN o USING (conv_id) WHERE o.pos > l.h),
p AS (SELECT conv_id, pos AS depth, text, string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY pos) AS upto FROM r
  UNION ALL SELECT conv_id, 0, '', '' FROM c),
m AS (SELECT conv_id, depth, text, min(conv_id) OVER (PARTITION BY depth, upto) AS node FROM p),
e AS (SELECT conv_id, max(depth) AS len FROM m GROUP BY conv_id),
n AS (SELECT node, depth, count(*) AS n_convs, (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) AS saved,
    string_agg(CASE WHEN depth = len THEN conv_id END::VARCHAR, ',' ORDER BY conv_id) AS ends
  FROM m JOIN e USING (conv_id) GROUP BY node, depth),
u AS (SELECT n.*, m.node AS parent FROM n LEFT JOIN m ON m.conv_id = n.node AND m.depth = n.depth - 1),
k AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM u WHERE depth > 0 GROUP BY ALL),
t AS (SELECT u.*, coalesce(n_children, 0) AS n_children FROM u LEFT JOIN k USING (node, depth)),
s AS (SELECT m.node, m.depth, sum(t.saved) AS saved, sum(CASE WHEN t.n_children = 0 THEN 1 ELSE 0 END) AS leaves
  FROM t JOIN m ON m.conv_id = t.node AND m.depth <= t.depth GROUP BY m.node, m.depth)
SELECT t.node AS conv_id, t.depth, t.parent AS parent_conv_id, t.n_convs, t.n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(t.ends, '')) AS ends_sha256
FROM t JOIN s USING (node, depth)
"""
