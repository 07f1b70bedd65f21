"""Queries of the operators over whole tables, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (
    chat,
    decontamination,
    fill_middle,
    fingerprints,
    language,
    licenses,
    mixing,
    ngram_join,
    packing,
    prefix_trie,
    sentences,
    toxicity,
    urls,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op5_sentence_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return sentences.removed_spans(table(spark, folder, "documents"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"), ["doc_id"])


def op8_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages"), ["page_id"])


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.neighbour_likeness(table(spark, folder, "documents"))


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similarity_components(table(spark, folder, "documents"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed_digests(table(spark, folder, "documents"), tokenizer)


def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digests(table(spark, folder, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_decontamination,
        op2_chat_formatting,
        op3_mixing,
        op4_language,
        op5_sentence_dedup,
        op6_toxicity,
        op7_licenses,
        op8_urls,
        op9_fingerprints,
        op10_ngram_join,
        op11_prefix_trie,
        op12_packing,
        op13_fill_middle,
    )
}

#: The trained and randomised operators have no SQL; the others are tested against brute
#: force, as all-pairs joins of shingles and runs are too slow in SQL on whole tables.
LLM_SQL: dict[str, str] = {"op11_prefix_trie": prefix_trie.SQL, "op13_fill_middle": fill_middle.SQL}
