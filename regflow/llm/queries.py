"""The registered queries of the operators; `oracle` has SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regflow.llm import (
    bpe,
    embedding_dedup,
    exact_dedup,
    fuzzy_hash,
    html_text,
    importance,
    merkle,
    mixing,
    ngram_join,
    pii,
    secret_scan,
    toxicity,
    warc,
)
from regflow.llm.common import fresh_path, table
from regflow.llm.oracle import ORACLE_SQL


def secret_columns(found: DataFrame) -> DataFrame:
    kinds = ("assign", "access", "hex")
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *(count(k) for k in kinds),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_columns(secret_scan.find_secrets(table(spark, folder, "documents")))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def personal_columns(found: DataFrame) -> DataFrame:
    kinds = ("email", "ip", "card", "phone")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *(count(k) for k in kinds),
        F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return personal_columns(pii.find_personal_data(table(spark, folder, "documents")))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_warc(table(spark, folder, "pages"), path)
    return warc.page_records(spark, path)


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, folder, "documents"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op7_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(table(spark, folder, "pages")).select(
        F.col("id").alias("page_id"),
        "text",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode(table(spark, folder, "documents"), vocabulary)
    return bpe.digests(bpe.decode(encoded, vocabulary))


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_fuzzy_hash(spark: SparkSession, folder: str) -> DataFrame:
    return fuzzy_hash.compare_with_edits(table(spark, folder, "documents"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    found = merkle.manifest(table(spark, folder, "documents"))
    tampered = F.crc32(F.col("id").cast("string").cast("binary")) % 7 == 0
    leaf = F.when(tampered, F.col("altered")).otherwise(F.col("leaf"))
    return found.select(
        F.col("id").alias("doc_id"),
        *(merkle.hex_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")),
        merkle.proof_digest().alias("proof_sha256"),
        merkle.hex_text(merkle.folded_root(leaf)).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_pii": op3_pii,
    "op4_warc": op4_warc,
    "op5_ngram_join": op5_ngram_join,
    "op6_mixing": op6_mixing,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_html_text": op9_html_text,
    "op10_bpe": op10_bpe,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_fuzzy_hash": op12_fuzzy_hash,
    "op13_merkle_manifest": op13_merkle_manifest,
}
