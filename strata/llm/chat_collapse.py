"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation once per turn, each time a little longer. Every
turn gets the rolling hash of its conversation up to there: a running sum of
two 64-bit hashes of (position, role, text). A conversation whose whole hash is
a proper prefix hash of another one is a snapshot of it; an anti-join keeps the
maximal ones, equal ones are kept once (smallest id), and these are rendered.

Positions come from range partitions, running sums from chunks of positions and
the chunk totals, so a conversation that holds a large part of all rows is spread
over many tasks, whatever its turn numbers are; its rendering comes in parts of one
chunk each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.functions import ordering
from strata.session import scratch_path

CHUNK_TURNS = 512
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _term(salt: int) -> Column:
    """Hash of a turn at its position; null and empty differ."""
    return F.xxhash64(F.lit(salt), "pos", F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))).cast("decimal(38,0)")


def rolled(turns: DataFrame, base: str, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """Distinct turns with `pos` (from 1), `chunk` (`chunk_turns` positions each, from 0),
    `n` (turns of the conversation) and the rolling hashes `h1`, `h2` up to the turn,
    stored under `base`, since several steps read them."""
    spark = turns.sparkSession
    order = [F.col(c).asc_nulls_last() for c in ("turn", "role", "text")]
    stored = ordering.in_parts(turns.distinct(), [F.col("conv_id"), *order], f"{base}/turns")
    placed = ordering.positions(stored, ["conv_id"], order).withColumn("chunk", F.floor((F.col("pos") - 1) / chunk_turns))
    placed = placed.withColumn("t1", _term(1)).withColumn("t2", _term(2))
    over, whole = Window.partitionBy("conv_id").orderBy("chunk"), Window.partitionBy("conv_id")
    sums = placed.groupBy("conv_id", "chunk").agg(F.sum("t1").alias("s1"), F.sum("t2").alias("s2"), F.count(F.lit(1)).alias("c")).select(
        "conv_id", "chunk", (F.sum("s1").over(over) - F.col("s1")).alias("b1"), (F.sum("s2").over(over) - F.col("s2")).alias("b2"), F.sum("c").over(whole).alias("n"))
    upto = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed.join(sums, ["conv_id", "chunk"]).select(
        "conv_id", "chunk", "pos", "n", "role", "text",
        (F.col("b1") + F.sum("t1").over(upto)).cast("string").alias("h1"), (F.col("b2") + F.sum("t2").over(upto)).cast("string").alias("h2")).write.parquet(f"{base}/rolled")
    return spark.read.parquet(f"{base}/rolled")


def render(role: Column, text: Column) -> Column:
    """One turn between its markers; a marker start inside the text is broken up."""
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("unknown")), F.lit("\n"), F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |")), F.lit(CLOSE + "\n"))


def collapse(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """Maximal conversations, rendered: `conv_id`, `part` (0 for the first `chunk_turns`
    turns, and so on), `n_turns` (of the conversation), `n_copies`
    (conversations equal to it), `chat` (the part's rendered turns).

    Turns are ordered by number, role, text, nulls last; repeated rows count
    once. Rows without a conversation id belong to none and are left out. A null
    role is rendered as `unknown`, a null text as empty. An empty table gives an
    empty result. Other columns are not read.
    """
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    rows = rolled(turns, scratch_path(turns.sparkSession, "chat-collapse"), chunk_turns)
    ends = rows.where("pos = n").groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    prefixes = rows.where("pos < n").select(F.col("pos").alias("n"), "h1", "h2").distinct()
    kept = ends.join(prefixes, ["n", "h1", "h2"], "left_anti").select("conv_id", "n", "n_copies")
    shown = rows.select("conv_id", "chunk", "pos", render(F.col("role"), F.col("text")).alias("line"))
    return (
        shown.join(kept, "conv_id").groupBy("conv_id", "chunk", "n", "n_copies")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines"))
        .select("conv_id", F.col("chunk").alias("part"), F.col("n").alias("n_turns"), "n_copies", F.array_join(F.col("lines.line"), "").alias("chat"))
    )


ORACLE = f"""
WITH d AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
  string_agg(coalesce(length(role)::VARCHAR, 'x') || ':' || coalesce(role, '') || coalesce(length(text)::VARCHAR, 'x') || ':' || coalesce(text, ''), '') OVER w AS upto
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST ROWS UNBOUNDED PRECEDING)),
e AS (SELECT n, upto, min(conv_id) AS conv_id, count(*) AS n_copies FROM p WHERE pos = n GROUP BY n, upto),
k AS (SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n AND p.pos = e.n AND p.upto = e.upto))
SELECT p.conv_id, CAST(floor((pos - 1) / {float(CHUNK_TURNS)}) AS BIGINT) AS part, k.n AS n_turns, k.n_copies,
  string_agg('{OPEN}' || coalesce(role, 'unknown') || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '{CLOSE}' || chr(10), '' ORDER BY pos) AS chat
FROM p JOIN k USING (conv_id) GROUP BY ALL
"""
