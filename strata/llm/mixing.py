"""Mixing sources to target weights by pivotal dependent rounding.

Each source's target is its weight's share of the wanted total, stopped at
`max_copies` times its size, the excess shared again by weight. A document of a
source with rate r = target / size is taken floor(r) times for sure and once
more with probability p = r - floor(r). The extra copies are drawn dependently:
every document holds a mass of p * size words out of size words; two documents
meet, and mass moves at random from one to the other, without changing either
expectation, until one of them is empty or full. The sum of masses never
changes, so a source's taken words end within one document of its target.

The meetings form a reduction tree: documents of a source are dealt by hash to
groups of about FAN_IN, a group is folded to at most one undecided document by
one array aggregation, and these residuals are dealt again until one per source
is left, which is decided by a draw. No group grows with its source; the
number of levels is the logarithm of the largest source. Masses are integers
(words times 2**20), so nothing is lost to rounding, and every draw is a hash of
the seed and the two documents, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.session import scratch_path

FAN_IN = 64
UNIT = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"

_ITEM = "struct<k:bigint,rid:bigint,m:bigint,s:bigint>"


def word_count(text: Column) -> Column:
    """Words of a whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[int, ...], share_percent: int, max_copies: int, base: str) -> DataFrame:
    """(source, source_size, target) per source. Sources are ordered by code point,
    null last, over a range partitioning and per-partition offsets, so no task
    sees all of them; the level at which targets stop is found by a few scalar
    aggregations."""
    spark = sized.sparkSession
    sums = sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sums.repartitionByRange(parts, F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id()).write.parquet(f"{base}/sources")
    stored = spark.read.parquet(f"{base}/sources")
    counts = stored.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").isNull(), F.col("source"))) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = stored.withColumn("place", place).join(before, "part").select(
        "source", "source_size", "n_docs", F.element_at(cycle, ((F.col("place") + F.col("before")) % len(weights) + 1).cast("int")).cast("bigint").alias("w"))
    ranked.write.parquet(f"{base}/weights")
    ranked = spark.read.parquet(f"{base}/weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while True:
        # A source is stopped when its share at the current level exceeds its cap; stopped sources stay stopped.
        stopped = F.lit(False) if level is None else F.col("source_size") * max_copies * level[1] <= F.col("w") * level[0]
        r = ranked.agg(F.sum(F.when(stopped, F.col("source_size")).otherwise(0)).alias("fixed"), F.sum(F.when(stopped, 0).otherwise(F.col("w"))).alias("w"),
                       F.sum(F.when(stopped, 1).otherwise(0)).alias("n")).first()
        # The level as a fraction: words per weight = (share * total - max_copies * fixed) / w, in hundredths.
        rest, w = share_percent * total - 100 * max_copies * (r["fixed"] or 0), 100 * (r["w"] or 0)
        if level is not None and (r["n"] == level[2] or w == 0 or rest <= 0):
            break
        level = (rest, w, r["n"])
        if w == 0:
            break
    cap = F.col("source_size") * max_copies
    if level[1] == 0:
        target = cap.cast("double")
    else:
        target = F.least(cap.cast("double"), F.col("w").cast("double") * F.lit(float(level[0]) / float(level[1])))
    return ranked.select("source", "source_size", "n_docs", target.alias("target"))


def _meet(seed: int):
    """Fold step: the undecided document so far meets the next one."""
    def step(acc: Column, x: Column) -> Column:
        r = acc["left"]
        up = F.least(r["s"] - r["m"], x["m"])
        down = F.least(r["m"], x["s"] - x["m"])
        # Up with probability down / (up + down): a draw below 2**31 against the exact ratio.
        draw = F.pmod(F.xxhash64(F.lit(seed), r["k"], x["k"], r["m"], x["m"]), F.lit(1 << 31))
        rise = draw.cast("double") * (up + down).cast("double") < down.cast("double") * float(1 << 31)
        move = F.when(rise, up).otherwise(-down)
        a, b = r["m"] + move, x["m"] - move
        mine = F.struct(r["k"].alias("k"), r["rid"].alias("rid"), a.alias("m"), r["s"].alias("s"))
        other = F.struct(x["k"].alias("k"), x["rid"].alias("rid"), b.alias("m"), x["s"].alias("s"))
        done_mine, done_other = (a == 0) | (a == r["s"]), (b == 0) | (b == x["s"])
        empty = F.lit(None).cast(_ITEM)
        met = F.struct(
            F.when(~done_mine, mine).when(~done_other, other).otherwise(empty).alias("left"),
            F.concat(acc["done"], F.when(done_mine, F.array(mine)).otherwise(F.array().cast(f"array<{_ITEM}>")),
                     F.when(done_other, F.array(other)).otherwise(F.array().cast(f"array<{_ITEM}>"))).alias("done"))
        return F.when(r.isNull(), F.struct(x.alias("left"), acc["done"].alias("done"))).otherwise(met)
    return step


def mix(docs: DataFrame, size_col: str = "size", id_col: str = "doc_id", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1),
        share_percent: int = 150, max_copies: int = 2, seed: int = 11, prefix: str = "mix_") -> DataFrame:
    """`docs` with the columns {prefix}source_size, {prefix}target (both of the
    row's source) and {prefix}copies (times the row is taken, 0 to `max_copies`).

    A null source is a source of its own, ordered last. A row of size 0 or null
    counts no words and is taken by its own draw. Equal rows are separate
    documents; equal or null ids are allowed. An empty table gives an empty
    result. Other columns pass through; those that start with `prefix` are
    replaced.
    """
    spark: SparkSession = docs.sparkSession
    base = scratch_path(spark, "mixing")
    keep = [c for c in docs.columns if not c.startswith(prefix)]
    # Row ids are given once and stored: later reads see the same ones whatever happens to a task.
    (
        docs.select(*keep, F.coalesce(F.col(size_col).cast("bigint"), F.lit(0)).alias(f"{prefix}size"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(size_col)).alias(f"{prefix}k"),
                    F.monotonically_increasing_id().alias(f"{prefix}rid"))
        .write.parquet(f"{base}/rows")
    )
    rows = spark.read.parquet(f"{base}/rows")
    slim = rows.select(F.col(source_col).alias("source"), F.col(f"{prefix}size").alias("size"), F.col(f"{prefix}k").alias("k"), F.col(f"{prefix}rid").alias("rid"))
    targets = source_targets(slim, weights, share_percent, max_copies, base).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_copies)))).otherwise(0.0))
    targets = targets.withColumn("p", F.floor((F.col("rate") - F.floor("rate")) * UNIT)).withColumn("number", F.xxhash64("source"))
    targets.write.parquet(f"{base}/targets")
    targets = spark.read.parquet(f"{base}/targets")
    same = F.col("source").eqNullSafe(F.col("t_source"))
    narrow = targets.select(F.col("source").alias("t_source"), "p", "n_docs")
    # Documents with a fractional mass; those of size 0 have none to share.
    # Equal keys (repeated rows, null ids) are told apart by their stored row ids; single ones by content alone.
    twice = slim.groupBy("source", "k").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("source").alias("d_source"), F.col("k").alias("d_k"), F.lit(1).alias("again"))
    slim = slim.join(twice, (F.col("k") == F.col("d_k")) & F.col("source").eqNullSafe(F.col("d_source")), "left").select(
        "source", "size", F.when(F.col("again") == 1, F.xxhash64("k", "rid")).otherwise(F.col("k")).alias("k"), "rid")
    items = slim.where("size > 0").join(narrow, same).where("p > 0").select(
        "source", F.struct("k", "rid", (F.col("p") * F.col("size")).alias("m"), (F.col("size") * UNIT).alias("s")).alias("item"), F.col("n_docs").alias("n"))
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    step, level, decided = _meet(seed), 0, []
    while True:
        groups = F.ceil(F.col("n") / F.lit(float(FAN_IN)))
        dealt = items.withColumn("group", F.pmod(F.xxhash64(F.lit(seed + level), "item.k"), groups))
        start = F.struct(F.lit(None).cast(_ITEM).alias("left"), F.array().cast(f"array<{_ITEM}>").alias("done"))
        folded = dealt.groupBy("source", "group", "n").agg(F.array_sort(F.collect_list("item")).alias("items")).select(
            "source", "n", F.aggregate("items", start, step).alias("r"))
        folded.write.parquet(f"{base}/level-{level}")
        folded = spark.read.parquet(f"{base}/level-{level}")
        decided.append(folded.select(F.explode("r.done").alias("d")).select("d.rid", (F.col("d.m") > 0).cast("int").alias("extra")))
        items = folded.where("r.left is not null").select("source", F.col("r.left").alias("item"), F.ceil(F.col("n") / F.lit(float(FAN_IN))).alias("n"))
        level += 1
        if most <= FAN_IN:
            break
        most = -(-most // FAN_IN)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.lit("last"), "item.k"), F.lit(1 << 31)).cast("double") / float(1 << 31)
    decided.append(items.select("item.rid", (draw * F.col("item.s") < F.col("item.m")).cast("int").alias("extra")))
    extra = decided[0]
    for d in decided[1:]:
        extra = extra.unionByName(d)
    own = targets.select(F.col("source").alias("t_source"), F.col("source_size").alias(f"{prefix}source_size"), F.col("target").alias(f"{prefix}target"), "rate")
    alone = F.pmod(F.xxhash64(F.lit(seed), F.lit("alone"), f"{prefix}k"), F.lit(1 << 31)).cast("double") / float(1 << 31) < F.col("rate") - F.floor("rate")
    bonus = F.when(F.col(f"{prefix}size") > 0, F.coalesce("extra", F.lit(0))).otherwise(alone.cast("int"))
    return (
        rows.join(extra.withColumnRenamed("rid", f"{prefix}rid"), f"{prefix}rid", "left")
        .join(own, F.col(source_col).eqNullSafe(F.col("t_source")))
        .select(*keep, f"{prefix}source_size", f"{prefix}target", F.least(F.floor("rate").cast("int") + bonus, F.lit(max_copies)).alias(f"{prefix}copies"))
    )
