"""Queries on the operators of this subpackage, and their SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import context_trees, conversations, decontam, fim, language_model, lines, neardup, packing, quality_rules, repeats, secret_scan, sharding, urls
from .oracle import ORACLE_SQL  # noqa: F401

URL_RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_docs(spark, sf_dir))


def op3_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return language_model.classify_quality(_docs(spark, sf_dir), labels.where("quality = 1 and toxic = 0"))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return urls.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(_docs(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_docs(spark, sf_dir).select("doc_id", "text"))
    kinds = [k for k, *_ in secret_scan.BASE]
    base = F.filter("secrets", lambda s: s["kind"].isin(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, kinds), F.sha2(secret_scan.written_spans(base).cast("binary"), 256).alias("base_sha256"), secret_scan.written_spans(F.col("secrets")).alias("spans"))


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_docs(spark, sf_dir).select("doc_id", "text"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long")
    placed = sharding.shard_documents(_docs(spark, sf_dir).select("doc_id", "text", crc.alias("text_crc32")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(_docs(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_documents(_docs(spark, sf_dir))
    return judged.select("doc_id", *quality_rules.STATS, "base_failed", "kept", "distance")


def op11_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_trees.score_documents(_docs(spark, sf_dir))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_digest(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle(_docs(spark, sf_dir)).drop("output")


QUERIES = {f.__name__: f for f in (op1_decontam, op2_pack, op3_perplexity, op4_urls, op5_lines, op6_secrets, op7_neardup, op8_shards, op9_repeats, op10_quality, op11_score, op12_repair, op13_fim)}
