"""Training-corpus pipeline over `documents`: each stage works on all that the one before kept.

Stages are written as Parquet to the shared folder and reread, so a lost executor repeats at most
part of one stage. All stages but the last return the columns of `documents`, further ones included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlake.llm import bpe, decontaminate, language, near_duplicates, personal_data
from seqlake.llm.rows import table
from seqlake.session import materialize

#: Near copies: sets of five-word shingles that share four fifths of their union.
SHINGLE_WORDS, PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter go; a missing `lang` becomes the predicted one."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of least id stays."""
    return near_duplicates.keep_one_of_each(docs, SHINGLE_WORDS, PERCENT)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of `benchmark` go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets become the name of their kind in brackets; `n_chars` follows."""
    return personal_data.redact_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers), n_tokens, and digests of the ids and of
    the text that they decode to."""
    decoded = bpe.decode_documents(bpe.encode_documents(docs))
    return decoded.select(
        "doc_id", "ids", F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", redact_personal_data),
    ("bpe", encode_tokens),
]

#: SQL has none of the stages' methods; the rows are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
