"""Registered queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    ann,
    conversation_trie,
    embedding_join,
    html_text,
    mixing,
    near_dedup,
    piece_codec,
    repeated_text,
    secret_scan,
    token_counts,
    toxicity,
    url_filter,
    vector_codes,
)
from ledgerlens.llm.oracle import ORACLE  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode(_table(spark, sf_dir, "documents"))


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_text.without_repeats(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.grade_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op9_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(_table(spark, sf_dir, "embeddings"))


URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_repeated_passages": op3_repeated_passages,
    "op4_toxicity": op4_toxicity,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_secret_scan": op6_secret_scan,
    "op7_html_text": op7_html_text,
    "op8_url_filter": op8_url_filter,
    "op9_embedding_join": op9_embedding_join,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_vector_codes": op13_vector_codes,
}
