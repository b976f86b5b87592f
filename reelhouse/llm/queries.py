"""The registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelhouse.llm import (
    byte_bpe, exact_dedup, language, main_text, mixing, near_dedup, periodic_runs, prefix_trie, secrets, simhash, token_files, toxicity, vector_search,
)
from reelhouse.llm.common import table


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    # Two scans through one ledger, as a store that grows takes them: the second finds half of the blobs known and scans the others.
    earlier = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    found = secrets.findings_by_path(docs, secrets.scan(docs, secrets.scan(earlier)))
    return found.withColumn("base_sha256", F.sha2("spans", 256))


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode_documents(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = main_text.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.learn_model(docs, table(spark, folder, "labels"), ~toxicity.held_out())
    rated = toxicity.scored(docs.select("doc_id", "text"), model)
    return rated.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.round_trip(table(spark, folder, "documents"), path, public_tokenizers.PATTERN, end_id=2, added=True)


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    found = language.identify(table(spark, folder, "documents").select("doc_id", "text", "lang"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"), rebuild=prefix_trie.rebuilt)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, folder, "documents"), loops=True)


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_secret_scan, op3_byte_bpe, op4_main_text, op5_vector_search, op6_mix_sources, op7_toxicity, op8_token_files,
    op9_near_dedup, op10_language, op11_simhash, op12_prefix_trie, op13_periodic_runs)}
CHECKS = {"op1_exact_dedup": exact_dedup.ORACLE, "op2_secret_scan": secrets.ORACLE, "op6_mix_sources": mixing.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE}
