"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seqlake.llm import (
    bit_planes, bpe, chat, decontaminate, divergence, html_text, language, near_duplicates, oracle,
    personal_data, quality, repeats, simple8b, toxicity,
)
from seqlake.llm.rows import table


def op1_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts look like control strings."""
    conflict = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", conflict), (-1, 1, "assistant", conflict)],
        "conv_id bigint, turn bigint, role string, text string")
    conversations = table(spark, sf_dir, "conversations").select(*extra.columns)
    return chat.conversation_digests(conversations.unionAll(extra))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op6_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.token_file_digests(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_spans(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.group_documents(table(spark, sf_dir, "documents"), words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_bit_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_planes.cluster_digests(table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.drop("evidence")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_repeats, op2_chat, op3_decontaminate, op4_bpe, op5_quality, op6_simple8b, op7_personal_data, op8_language,
        op9_html, op10_near_duplicates, op11_divergence, op12_bit_plane_clusters,
        op13_toxicity)
}

#: DuckDB SQL where it can express a query.
ORACLE_SQL: dict[str, str] = {
    "op2_chat": oracle.CHAT, "op5_quality": oracle.QUALITY, "op11_divergence": oracle.DIVERGENCE,
    "op12_bit_plane_clusters": oracle.clusters(),
}
