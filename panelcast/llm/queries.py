"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import (
    contexttree, conversations, decontaminate, filteraudit, language, licences, mixing, sharding, simhash, substrings, tokens, vectors,
    warc,
)
from panelcast.sources.sinks import intermediate_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = intermediate_path(spark, "warc")
    warc.write_archive(table(spark, folder, "pages"), path)
    return warc.page_records(spark, path)


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


def op4_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan_licences(table(spark, folder, "documents"))


def op5_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.drop_repeated(table(spark, folder, "documents"), with_text=False).drop("kept")


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.document_languages(table(spark, folder, "documents"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents, _ = mixing.mix(table(spark, folder, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken")


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op9_tokens(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = intermediate_path(spark, "tokens")
    tokens.write_ids(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return tokens.read_ids(spark, path, with_ids=False).drop("ids")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_filters(spark: SparkSession, folder: str) -> DataFrame:
    return filteraudit.filter_interactions(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_report(conversations.damage(table(spark, folder, "conversations")))


def op13_contexttree(spark: SparkSession, folder: str) -> DataFrame:
    return contexttree.score_texts(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_vectors": op1_vectors,
    "op2_warc": op2_warc,
    "op3_sharding": op3_sharding,
    "op4_licences": op4_licences,
    "op5_substrings": op5_substrings,
    "op6_language": op6_language,
    "op7_mixing": op7_mixing,
    "op8_simhash": op8_simhash,
    "op9_tokens": op9_tokens,
    "op10_decontamination": op10_decontamination,
    "op11_filters": op11_filters,
    "op12_conversations": op12_conversations,
    "op13_contexttree": op13_contexttree,
}
