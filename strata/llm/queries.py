"""The registered `opN_<name>` queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import chat_collapse, fingerprint, language_id, license_scan, line_crf, mixing, ngram_join, pii_surrogates, piece_bpe, prefix_trie, vptree, warc, whitening
from strata.llm.shipping import ship_package
from strata.session import scratch_path

#: The session setting that names the secret of the surrogates.
PII_KEY = "spark.strata.pii.key"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = ngram_join.jaccard_classes(table(spark, sf_dir, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "component_size")


ORACLE["op1_ngram_jaccard_join"] = ngram_join.ORACLE


@query
def op3_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_crf.assess(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_id.train(docs, ~held_out)
    return language_id.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = piece_bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), packed=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(docs).select("doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
                                   (F.col("size") * F.col("mix_copies")).alias("taken"))


@query
def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(PII_KEY, pii_surrogates.PUBLIC_KEY)
    return pii_surrogates.replace_pii(table(spark, sf_dir, "documents"), key).select("doc_id", "text", "n_entities")


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op6_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_collapse.collapse(table(spark, sf_dir, "conversations"))


ORACLE["op2_license_scan"] = license_scan.oracle()
ORACLE["op6_chat_collapse"] = chat_collapse.ORACLE


@query
def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages"), with_html=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


ORACLE["op4_warc_round_trip"] = warc.ORACLE
ORACLE["op5_vantage_point_search"] = vptree.oracle()


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"), scratch_path(spark, "prefix-trie"))
    return prefix_trie.prefix_trie(prefix_trie.lend_heads(turns))


ORACLE["op11_prefix_trie"] = prefix_trie.ORACLE


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))
