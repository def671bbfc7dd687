"""Silver summaries: counts of one or two columns, most frequent first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlake.functions.text import or_else
from seqlake.sources.files import write_csv
from seqlake.vocab import MISSING

# Summary name: the silver table it counts and the columns it counts by.
SUMMARIES = {
    "sample_domain_counts": ("sra_sample_classification", ["sample_domain"]),
    "organism_group_counts": ("sra_sample_classification", ["organism_group"]),
    "sample_context_counts": ("sra_sample_classification", ["sample_context"]),
    "sample_domain_context_counts": (
        "sra_sample_classification", ["sample_domain", "sample_context"]),
    "attribute_category_counts": ("sra_sample_attribute", ["attribute_category"]),
    "library_strategy_counts": ("sra_run", ["library_strategy"]),
}


def count_by_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows per combination of fields; a blank value counts as 'missing'."""
    return (
        df.groupBy(*[or_else(F.col(f), MISSING).alias(f) for f in fields])
        .agg(F.count("*").alias("count")).orderBy(F.desc("count"), *fields)
    )


def count_rows(df: DataFrame, fields: list[str], name: str) -> DataFrame:
    """Rows per combination of fields, with NULL as a group of its own."""
    return df.groupBy(*fields).agg(F.count("*").alias(name)).orderBy(
        F.desc(name), *[F.asc_nulls_last(f) for f in fields]
    )


def domain_library_strategy_counts(runs: DataFrame, classification: DataFrame) -> DataFrame:
    """Runs per domain and strategy; a sample joins with one row per strategy it has."""
    per_sample = (
        runs.where(F.col("sample_accession").isNotNull())
        .groupBy("sample_accession", "library_strategy").agg(F.count("*").alias("n"))
    )
    domains = classification.select("sample_accession", "sample_domain")
    return (
        per_sample.join(domains, "sample_accession")
        .groupBy("sample_domain", "library_strategy").agg(F.sum("n").alias("run_count"))
        .orderBy(F.desc("run_count"), "sample_domain", F.asc_nulls_last("library_strategy"))
    )


def summarize_silver(silver: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Write every summary as one small CSV and return the row counts."""
    counts = {}
    for name, (table, fields) in SUMMARIES.items():
        summary = count_by_fields(silver[table], fields)
        path = f"{folder.rstrip('/')}/{name}.csv"
        write_csv(summary.withColumn("count", F.col("count").cast("string")), path, single_file=True)
        counts[name] = silver[table].sparkSession.read.option("header", True).csv(path).count()
    return counts
