"""The registered queries over the text tables: each applies an operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontamination, deobfuscation, divergence, oracle, pii, prefix_trie, ranked_search, ring, secrets, simhash
from tidemark.llm import string_kernel, token_counts, warc
from tidemark.llm.common import Shelf, bucket, documents
from tidemark.llm.spans import joined, number

RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"

# Tokens above which a text counts as too long.
MOST_TOKENS = 4096


def _base_sha256(kinds: list[str]):
    return F.sha2(joined(F.col("base"), kinds).cast("binary"), 256).alias("base_sha256")


def op1_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))
    return found.select(
        "doc_id", *[number(F.col("base"), k).alias(f"n_{k}") for k in secrets.KINDS], _base_sha256(secrets.KINDS),
        joined(F.concat("base", "added"), [*secrets.KINDS, secrets.ADDED]).alias("spans"),
        *[f"n_{v}" for v in secrets.VERDICTS],
    )


def op2_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir))
    return found.select(
        "doc_id", *[number(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS], _base_sha256(pii.KINDS),
        joined(F.concat("base", "added"), [*pii.KINDS, *pii.ADDED]).alias("spans"),
    )


def op3_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op4_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge_documents(documents(spark, sf_dir))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontamination.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.as_responses(documents(spark, sf_dir, "pages")))


def op7_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.assign(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "home_shard", "hops",
    )


def op8_language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = string_kernel.identify(docs, string_kernel.fit(docs))
    held_out = F.coalesce(bucket(F.col("doc_id"), string_kernel.FOLDS) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def ranks(name: str = RANKS) -> dict[bytes, int]:
    return bpe.read_ranks(public_tokenizers.path(name))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(documents(spark, sf_dir), ranks(), public_tokenizers.PATTERN))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = deobfuscation.score(docs, deobfuscation.fit(docs, documents(spark, sf_dir, "labels")))
    held_out = F.coalesce(bucket(F.col("doc_id"), deobfuscation.FOLDS) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", deobfuscation.predicted(F.col("score")).alias("predicted"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = token_counts.read_model(public_tokenizers.path(PIECES))
    return token_counts.count_tokens(documents(spark, sf_dir), model).withColumn("over_limit", token_counts.over_limit(MOST_TOKENS))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.sequences(documents(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(turns, Shelf(spark)))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_ownership, op2_pii_sanitisation, op3_simhash_near_duplicates, op4_quality_divergence,
        op5_benchmark_decontamination, op6_warc_derivatives, op7_bounded_ring, op8_language_identification,
        op9_bpe_round_trip, op10_toxicity, op11_token_counts, op12_prefix_trie, op13_ranked_search,
    )
}

ORACLE: dict[str, str] = oracle.ORACLE
