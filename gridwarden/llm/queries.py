"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, chat, contamination, exact, jaccard, licenses, mixing, packing, prefixes, quality, spelling, tokens, toxicity,
)
from .common import remainder, table

THRESHOLD = 0.3


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.quality_model(docs, labels.where(remainder("doc_id", 5) != 0))
    rows = quality.scored(docs.select("doc_id", "text"), model)
    return rows.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(probe).alias("text"),
    )
    return chat.digests(chat.chat_examples(turns.union(extra)))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_tokens(
        table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_copies(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.toxicity_model(docs, labels.where(remainder("doc_id", 4) != 2))
    return toxicity.toxicity_scores(docs, model).select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), every=97, least_length=5, least_count=3)
    return spelling.spelling_variants(words)


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _tokenizer("word_bpe_49k.json")
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path))


def op13_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(prefixes.rebuilt(table(spark, sf_dir, "conversations")))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_quality, op2_token_counts, op3_chat, op4_packing, op5_jaccard, op6_exact, op7_licenses, op8_toxicity,
        op9_contamination, op10_mixing, op11_spelling, op12_bpe, op13_prefixes,
    ]
    return {f.__name__: f for f in found}
