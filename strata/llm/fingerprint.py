"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

A text's set holds the hashes of its 5-word shingles (in lower case; a shorter text
is one shingle, a text without words has the empty set). Each shingle is hashed
once: the upper bits choose one of BINS bins, the least hash of a bin is kept.

*Optimal densification.* An empty bin probes bins drawn by a hash of its own
number and the probe's until it meets one that was filled at first, and takes
that bin's value; every empty bin draws on its own. After PROBES probes without
luck (texts of few shingles) the filled bin with the least hash of (empty bin,
filled bin) is taken, which is the end of the same kind of random search, so it
always finishes.

*Packed bits.* Each bin keeps BITS low-order bits, packed into 64-bit words and
written as hexadecimal digits. Two unequal bins agree in BITS bits by chance with
probability r = 2^-BITS, so the likeness is (agreeing share - r) / (1 - r), at
least 0.

*Neighbours.* Documents are numbered along their ids by range partitions, so
each learns the key of the one before and the next. Texts are shuffled once by key;
the opening that the document before needs is sent to it, at most half of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.functions import ordering
from strata.session import scratch_path

BINS, BITS, PROBES, WORDS = 256, 4, 12, 5
#: Rows that one task writes for one document that the table repeats.
COPY_ROWS = 4096


def _empty() -> Column:
    """An array<bigint> without items, which cannot hold nulls either."""
    return F.slice(F.array(F.lit(0).cast("bigint")), 1, 0)


def shingle_hashes(words: Column, k: int) -> Column:
    """One hash per window of k words; of a shorter text one over all words."""
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, k)))
    return F.when(F.size(words) > 0, windows).otherwise(_empty())


def with_fingerprint(rows: DataFrame, text: str, name: str, bins: int = BINS, bits: int = BITS, k: int = WORDS) -> DataFrame:
    """Adds `name`: the text's packed fingerprint, array<bigint> of bins * bits / 64
    words. Null counts as empty; texts without words have an empty array. `bins` is
    a power of two, `bits` one of 1, 2, 4, 8, 16, 32; their product a multiple of 64."""
    shift, per_word, mask = 64 - (bins.bit_length() - 1), 64 // bits, (1 << bits) - 1

    def bin_of(h: Column) -> Column:
        """Bins ascend with the signed hash, so sorted hashes come bin by bin."""
        return F.shiftright(h, shift).cast("int") + bins // 2

    def probe(j: Column, turn: int) -> Column:
        return F.get(filled, F.pmod(F.xxhash64(j, F.lit(turn)), F.lit(bins)).cast("int"))

    def last_resort(j: Column) -> Column:
        return F.array_min(F.transform(first, lambda x: F.struct(F.xxhash64(j, bin_of(x)).alias("rank"), x.alias("value"))))["value"]

    def pack(start: Column) -> Column:
        low = F.lit(mask).cast("bigint")
        return F.aggregate(F.slice(dense, start, per_word), F.lit(0).cast("bigint"), lambda acc, x: F.shiftleft(acc, bits).bitwiseOR(x.bitwiseAND(low)))

    steps = {c: f"__{c}_{name}" for c in ("words", "hashes", "first", "filled", "dense")}
    words, hashes, first, filled, dense = map(F.col, steps.values())
    none = F.lit(None).cast("bigint")
    # Every step is a column that the next one names more than once, so it is computed once per row.
    split = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[\x20\x09-\x0d]+")
    rows = rows.withColumn(steps["words"], F.filter(split, lambda x: x != ""))
    rows = rows.withColumn(steps["hashes"], F.sort_array(shingle_hashes(words, k)))
    rows = rows.withColumn(steps["first"], F.filter(hashes, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(hashes, i - 1)))))
    skipped = F.transform(first, lambda x, i: F.concat(F.array_repeat(none, bin_of(x) - F.coalesce(bin_of(F.get(first, i - 1)), F.lit(-1)) - 1), F.array(x)))
    after = bins - 1 - F.coalesce(bin_of(F.get(first, F.size(first) - 1)), F.lit(bins - 1))
    rows = rows.withColumn(steps["filled"], F.concat(F.flatten(skipped), F.array_repeat(none, after)))
    searched = F.transform(filled, lambda x, j: F.coalesce(x, *[probe(j, t) for t in range(PROBES)], last_resort(j)))
    rows = rows.withColumn(steps["dense"], F.when(F.size(first) > 0, searched).otherwise(_empty()))
    rows = rows.withColumn(name, F.when(F.size(dense) > 0, F.transform(F.sequence(F.lit(1), F.lit(bins), F.lit(per_word)), pack)).otherwise(_empty()))
    return rows.drop(*steps.values())


def as_text(packed: Column) -> Column:
    """16 hexadecimal digits per word; the empty set is the empty string."""
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The estimated Jaccard similarity of two packed fingerprints, 0 to 1; of two
    empty sets 1, of an empty and another set 0."""
    lane = sum(1 << (i * bits) for i in range(64 // bits))
    lane = F.lit(lane - (1 << 64) if lane >= 1 << 63 else lane).cast("bigint")

    def differing(x: Column, y: Column) -> Column:
        z, step = x.bitwiseXOR(y), 1
        while step < bits:
            z = z.bitwiseOR(F.shiftrightunsigned(z, step))
            step *= 2
        return F.bit_count(z.bitwiseAND(lane))

    differ = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda acc, x: acc + x)
    chance = 2.0**-bits
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), ((1 - differ / F.lit(float(bins))) - chance) / (1 - chance))))


def neighbours(keyed: DataFrame, base: str) -> DataFrame:
    """(doc_id, h, copies, need, next_*, prev_*) per distinct (doc_id, h, n_chars): in
    ascending order (null id first) the keys of the next and the previous document, the
    last one's next being the first, and the opening that the previous one needs."""
    spark = keyed.sparkSession
    key = F.struct("doc_id", "h", "n_chars")
    docs = keyed.groupBy("doc_id", "h", "n_chars").agg(F.count(F.lit(1)).alias("copies"))
    order = [F.col("doc_id"), F.col("h"), F.col("n_chars")]
    stored = ordering.in_parts(docs, order, f"{base}/order")
    ends = stored.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    # One row per range partition; the ring closes over them.
    over = Window.orderBy("part")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lead("first").over(over), F.first("first").over(whole)).alias("after"),
                       F.coalesce(F.lag("last").over(over), F.last("last").over(whole)).alias("before"))
    inside = Window.partitionBy("part").orderBy(*order)
    ring = stored.withColumn("next", F.lead(key).over(inside)).withColumn("prev", F.lag(key).over(inside)).join(ends, "part")
    ring.select(*order, "copies", F.coalesce("next", "after").alias("next"), F.coalesce("prev", "before").alias("prev")).write.parquet(f"{base}/ring")
    return spark.read.parquet(f"{base}/ring")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, bits: int = BITS, k: int = WORDS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_chars (code points), edited_sha256,
    fingerprint, edited_fingerprint (hexadecimal), near_edited, near_next.

    The edited text is the text with its last floor(n_chars / 2) code points replaced
    by the first as many (or all) of the next document's. Documents are ordered by id
    (null first), those that share an id by a hash of the text; rows equal in id and
    text are one document and get the same row each. A single document is its own
    next. A null text is empty; an empty table gives an empty result. Other columns
    are not read, whatever their names.
    """
    spark = docs.sparkSession
    base = scratch_path(spark, "fingerprint")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    keyed = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("h"), F.char_length("text").cast("bigint").alias("n_chars"), "text")
    ring = neighbours(keyed.drop("text"), base)
    # A null id equals itself here: the key carries its absence.
    key = [F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("no_id"), "h", "n_chars"]
    names = ["i", "no_id", "h", "n_chars"]

    def of(neighbour: str) -> list[Column]:
        return [F.coalesce(f"{neighbour}.doc_id", F.lit(0)).alias("i"), F.col(f"{neighbour}.doc_id").isNull().alias("no_id"), F.col(f"{neighbour}.h").alias("h"), F.col(f"{neighbour}.n_chars").alias("n_chars")]

    texts = keyed.select(*key, "text").groupBy(*names).agg(F.first("text").alias("text"))
    opening = F.floor(F.col("prev.n_chars") / 2).cast("int")
    placed = texts.join(ring.select(*key, F.col("prev")), names)
    sent = placed.select(*of("prev"), F.substring("text", F.lit(1), opening).alias("opening"))
    half = F.floor(F.col("n_chars") / 2)
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.col("opening"))
    both = texts.join(sent, names).select(*names, "text", edited.alias("edited"))
    both = with_fingerprint(both.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256)), "text", "fp", bins, bits, k).drop("text")
    prints = stored(with_fingerprint(both, "edited", "edited_fp", bins, bits, k).drop("edited"), "prints")

    mine = ring.join(prints.select(F.col("i").alias("pi"), F.col("no_id").alias("pn"), F.col("h").alias("ph"), F.col("n_chars").alias("pc"), "edited_sha256", "fp", "edited_fp"),
                     (F.coalesce("doc_id", F.lit(0)) == F.col("pi")) & (F.col("doc_id").isNull() == F.col("pn")) & (F.col("h") == F.col("ph")) & (F.col("n_chars") == F.col("pc")))
    nexts = prints.select(F.col("i").alias("ni"), F.col("no_id").alias("nn"), F.col("h").alias("nh"), F.col("n_chars").alias("nc"), F.col("fp").alias("next_fp"))
    met = mine.join(nexts, (F.coalesce("next.doc_id", F.lit(0)) == F.col("ni")) & (F.col("next.doc_id").isNull() == F.col("nn")) & (F.col("next.h") == F.col("nh")) & (F.col("next.n_chars") == F.col("nc")))
    rows = met.select("doc_id", "n_chars", "h", "copies", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                      likeness(F.col("fp"), F.col("edited_fp"), bins, bits).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp"), bins, bits).alias("near_next"))
    # Rows that the table repeats are dealt out in runs, so no task writes all copies of one.
    runs = rows.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPY_ROWS))))
    runs = runs.repartition("doc_id", "h", "run").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.col("copies") - F.col("run") * COPY_ROWS, F.lit(COPY_ROWS)))))
    return runs.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
