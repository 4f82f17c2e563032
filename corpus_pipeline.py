"""The corpus pipeline: toxicity, near-duplicates, benchmark passages, personal data, tokens.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontamination, deobfuscation, pii, simhash
from tidemark.llm.common import Shelf, documents
from tidemark.llm.queries import ranks


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deobfuscation.without_toxic(docs, documents(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keep = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    return bpe.digests(bpe.round_trip(docs, ranks(), public_tokenizers.PATTERN, keep=keep), keep)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", sanitise),
    ("tokens", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        shelf = Shelf(spark)
        docs = shelf.put(stage(spark, docs, sf_dir), name)
        # Nothing reads a stage's input once its result is written.
        if before:
            before.__exit__()
        before = shelf
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
