"""Registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm import bpe, conversations, hnsw, mixing, quality, rules, sharding, simhash, suffix, token_file, toxicity, url_filter, whitening
from flowspark.llm.common import table

URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out(F.col("doc_id")))
    found = toxicity.score(docs, model)
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "examples", "cosines")


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.token_file(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.vector_links(table(spark, sf_dir, "embeddings"))


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeats(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_filter(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rules.fit(docs, table(spark, sf_dir, "labels"), ~rules.held_out(F.col("doc_id")))
    return rules.score(docs, model).select("doc_id", rules.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "rules")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.repair(table(spark, sf_dir, "conversations")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
