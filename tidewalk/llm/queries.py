"""The registered queries of the operators over their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tidewalk.llm import (
    decontamination, filter_audit, language, lattice, lexical, packing, secrets, sharding, simhash, token_counts,
    token_output, urls, wrappers,
)
from tidewalk.llm.common import read
from tidewalk.llm.oracles import ORACLES
from tidewalk.llm.tokens import default_tokenizer, word_tokenizer
from tidewalk.sources.tables import new_working_path

# The rules of the URL query.
URL_RULES = [
    urls.rule("allow", "org/"), urls.rule("block", "example.org/es/"), urls.rule("block", "example.org/en/1"),
    urls.rule("allow", "com/fr/"), urls.rule("block", "com/de/"),
]
ORDER_KEY = 20_240_229


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all shards, read back from the files."""
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    folder = new_working_path(spark, "training-order")
    schema = "doc_id long, piece int, n_tokens long, slot long, shard int, offset long, ids_crc32 long"
    if not token_output.write_training_order(documents, folder, default_tokenizer(), ORDER_KEY):
        return spark.createDataFrame([], schema)
    records = token_output.read_training_order(spark, folder)
    return records.select(
        "doc_id", "piece", "n_tokens", "slot", "shard", "offset", F.crc32("ids").cast("long").alias("ids_crc32")
    )


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), words_per_shingle=3, max_bits=3)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = language.held_out(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    model = language.learn(documents.where("NOT held_out"))
    found = language.identify(documents.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    return decontamination.contaminated(documents, read(spark, sf_dir, "benchmark", "item_id", "text"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), least=0.9)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.assign(read(spark, sf_dir, "documents", "doc_id", "text"), shards=16)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(documents, default_tokenizer(), capacity=2048)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text")
    return lexical.search(documents, items, k=10)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return filter_audit.audit(documents, read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents", "doc_id", "text"), word_tokenizer(), limit=2048)


QUERIES = {
    query.__name__: query
    for query in (
        op1_training_order, op2_simhash_near_dedup, op3_secret_scans, op4_url_filters, op5_language_id,
        op6_html_extraction, op7_benchmark_decontamination, op8_embedding_near_dedup, op9_sharding,
        op10_best_fit_packing, op11_lexical_search, op12_filter_audit, op13_token_counts,
    )
}
__all__ = ["ORACLES", "QUERIES"]
