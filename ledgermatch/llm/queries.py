"""The registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, byte_bpe, conversation_repair, decontaminate, exact_dedup, licenses, line_dedup, mixing, secrets, simhash,
    token_store, toxicity, warc_zip,
)

from .common import text_or_empty


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner: the source; repository: a language section of a source."""
    docs = table(spark, sf_dir, "documents")
    return secrets.contract_columns(secrets.scan_secrets(docs, repo=F.concat_ws("/", "source", "lang")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: production weights of the mix; the documents have no domain, so a hash of the source stands for one
MIX_WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}


def source_domain() -> Column:
    return F.concat(F.lit("d"), F.conv(F.substring(F.md5(F.coalesce("source", F.lit(""))), 1, 2), 16, 10).cast("int") % 4)


def mix_documents(docs: DataFrame) -> DataFrame:
    """Half of all tokens, by the production weights, in at most two epochs."""
    return mixing.mix(docs, source_domain(), MIX_WEIGHTS, F.floor(F.col("tokens") / 2))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Trained on the labels outside the held-out fifth."""
    return toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~toxicity.held_out()))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    score = toxicity.score_column(text_or_empty("text"), toxicity_model(spark, docs, sf_dir))
    return docs.select("doc_id", toxicity.held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("matches") > 0).alias("contaminated"),
                        F.size("matches").cast("long").alias("n_items"),
                        F.concat_ws(",", F.sort_array("matches.item_id").cast("array<string>")).alias("items"),
                        F.array_min("matches.distance").alias("least_distance"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_all_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.concat_ws(",", "licenses").alias("licenses"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_counts(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.round_trip(table(spark, sf_dir, "documents"))
    return coded.select("doc_id", F.floor(F.length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_line_dedup, op3_warc_zip, op4_source_mix, op5_toxicity, op6_decontaminate, op7_license_scan,
    op8_simhash_near_dedup, op9_token_counts, op10_exact_dedup, op11_conversation_repair, op12_cross_tokenizer_alignment,
    op13_byte_bpe)}
