"""A corpus pipeline over the `documents` table: five stages, each one operator.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame; the runner writes it as Parquet and the next stage
reads that. All but the last return the columns of `documents` (extra columns
pass through).

1. language ID: rows without a letter, or unlike the learned rows of their best
   language, go; `lang` becomes the predicted language.
2. n-gram Jaccard join: of each class of near-duplicates the row with the
   smallest doc_id stays (of equal ids one by its place in the files).
3. PII: entities in `text` are replaced by surrogates, `n_chars` follows.
4. mixing: rows are left out or repeated so that sources meet their targets.
5. SentencePiece: token ids of every remaining row, and whether decoding them
   gives the text again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import language_id, mixing, ngram_join, pii_surrogates, piece_bpe
from strata.llm.shipping import ship_package
from strata.session import scratch_path


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and letterless texts go; without any labelled row every other text stays as it is."""
    ship_package(spark)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_id.train(docs, ~held_out)
    if not model.families:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    named = language_id.identify(docs, model, lang_name="__lang", score_name="__score", like_name="__like").where(
        (F.col("__lang") != "und") & F.col("__like"))
    return named.select(*[F.col("__lang").alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def positioned(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """`docs` read straight from files, which give every row its position; other frames are stored first."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        path = scratch_path(spark, "positioned")
        docs.write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return docs


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a null or word-less text are classes of their own and stay."""
    ship_package(spark)
    # A row is known by its file and its position there, however the file is split.
    docs = positioned(spark, docs)
    numbered = docs.select("*", F.struct("doc_id", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("__id"))
    classes = ngram_join.jaccard_classes(numbered.select("__id", "text"), id_col="__id")
    stay = classes.where(F.col("id") == F.col("component_id")).select(F.col("id.file").alias("__file"), F.col("id.row").alias("__row"))
    numbered = numbered.withColumn("__file", F.col("__id.file")).withColumn("__row", F.col("__id.row"))
    return numbered.join(stay, ["__file", "__row"], "left_semi").select(*docs.columns)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts stay null. The session setting spark.strata.pii.key names the secret."""
    key = spark.conf.get("spark.strata.pii.key", pii_surrogates.PUBLIC_KEY)
    done = pii_surrogates.replace_pii(docs, key, count_col="__entities")
    return done.select(*[F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row appears as many times as the mix takes it."""
    docs = positioned(spark, docs)
    place = [F.xxhash64("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    sized = docs.select("doc_id", "source", *place, mixing.word_count(F.col("text")).alias("__size"))
    # The choice is made without the texts.
    taken = mixing.mix(sized, size_col="__size", prefix="__mix_").where(F.col("__mix_copies") > 0).select("__file", "__row", "__mix_copies")
    rows = docs.select("*", *place).join(taken, ["__file", "__row"])
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip); a null text has the begin and end ids only."""
    import public_tokenizers

    ship_package(spark)
    coded = piece_bpe.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["text"])
    return coded.select("doc_id", "n_tokens", "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("language ID", keep_languages),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("PII", replace_private),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", tokenise),
]

#: The stages hold learned models, hashed draws and BPE merges, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{number}")
        docs = spark.read.parquet(f"{base}/{number}")
    return docs
