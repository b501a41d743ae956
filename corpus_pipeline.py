"""A corpus pipeline of five stages, each a call of one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewalk.llm import decontamination, language, packing, secrets, simhash
from tidewalk.llm.common import materialise, read
from tidewalk.llm.tokens import default_tokenizer

LEAST_SHARE = 0.4  # of its main language, in a document that stays: one with a passage in another language is clean


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose main language is known and has at least `LEAST_SHARE` of the text stay."""
    model = language.learn(language.held_out(docs).where("NOT held_out"))
    found = language.identify(docs, model, "__language", "__share")
    known = (F.col("__language") != language.UNKNOWN) & (F.col("__share") >= LEAST_SHARE)
    return found.where(known).select(docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.deduplicate(docs, words_per_shingle=3, max_bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items, literal or re-parameterised, stay."""
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; their secrets are masked."""
    return secrets.mask_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, default_tokenizer(), capacity=2048)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# Language mixtures, 64-bit hashes of shingles and a tokenizer's merges have no SQL; tests hold the run's rows against
# plain implementations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
