"""The whole lake in one call: batch files to bronze, silver, gold, summaries and quality report."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from seqlake import schemas
from seqlake.functions.text import utc_stamp
from seqlake.operators.attributes import attribute_dictionary
from seqlake.plans import bronze, gold, quality, silver, summary, taxonomy
from seqlake.session import stored
from seqlake.sources.files import (
    blanks_to_null, exists, latest_matching, newest_snapshot, read_csv_strings, read_tables,
    require, write_csv, write_parquet,
)
from seqlake.sources.snapshots import commit_snapshot, newest_tables


@dataclass(frozen=True)
class LakePaths:
    """Where everything is, below one root; every folder can be set on its own."""

    root: str = "data"
    batches: str = ""
    ingested: str = ""
    ingest_manifest: str = ""
    combined: str = ""
    silver: str = ""
    silver_parquet: str = ""
    summary: str = ""
    gold: str = ""
    taxonomy_reference: str = ""
    taxonomy_manifest: str = ""
    quality_report: str = ""

    def __post_init__(self) -> None:
        defaults = {
            "batches": "bronze/sra/batches",
            "ingested": "bronze/sra/ingested",
            "ingest_manifest": "manifests/sra/ingested.jsonl",
            "combined": "bronze/sra/combined",
            "silver": "silver/sra",
            "silver_parquet": "silver/sra/parquet",
            "summary": "silver/sra/summary",
            "gold": "gold/sra/parquet",
            "taxonomy_reference": "reference/ncbi_taxonomy/taxonomy_reference.csv",
            "taxonomy_manifest": "manifests/ncbi_taxonomy/taxonomy-reference-updates.jsonl",
            "quality_report": "quality/sra/quality-report.csv",
        }
        for name, path in defaults.items():
            if not getattr(self, name):
                object.__setattr__(self, name, f"{self.root.rstrip('/')}/{path}")

    def silver_csv(self) -> dict[str, str]:
        return {name: f"{self.silver}/{name}.csv" for name in schemas.SILVER}

    def silver_tables(self) -> dict[str, str]:
        return {name: f"{self.silver_parquet}/{name}.parquet" for name in schemas.SILVER}

    def gold_tables(self) -> dict[str, str]:
        return {name: f"{self.gold}/{name}.parquet" for name in schemas.GOLD}


# Combined bronze tables, one per run of `combine`; a UTC stamp follows the prefix.
COMBINED = {"runs": "sra-bronze-combined", "attributes": "sra-sample-attributes-combined"}


def combine(
    spark: SparkSession, paths: LakePaths, dictionary_path: str | None = None,
) -> dict[str, int]:
    """Write combined bronze as Parquet, with the row order that silver relies on. Its input is
    batch files, batches ingested from landed XML, or both."""
    merged = bronze.combine_batches(
        spark, paths.batches, attribute_dictionary(spark, dictionary_path),
        paths.ingested, paths.ingest_manifest)
    stamp = spark.range(1).select(utc_stamp()).first()[0]
    files = {name: f"{paths.combined}/{prefix}-{stamp}-{uuid.uuid4().hex[:8]}.parquet"
             for name, prefix in COMBINED.items()}
    counts = {name: write_parquet(df, files[name]) for name, df in merged.items()}
    commit_snapshot(spark, paths.combined, files)
    return counts


def read_combined(spark: SparkSession, paths: LakePaths) -> dict[str, DataFrame]:
    """The combined tables that were committed last. A lake from before the log has tables only; of
    those the newest whole ones are read."""
    committed = newest_tables(spark, paths.combined)
    return {
        name: spark.read.parquet(
            committed[name] if committed
            else latest_matching(spark, paths.combined, f"{prefix}-*.parquet"))
        for name, prefix in COMBINED.items()
    }


def _read_silver(spark: SparkSession, paths: LakePaths) -> dict[str, DataFrame]:
    return read_tables(spark, paths.silver_parquet, list(schemas.SILVER), "Silver Parquet table")


def build_silver(
    spark: SparkSession, paths: LakePaths, text_copies: bool = False
) -> dict[str, int]:
    """Write silver as Parquet, where a missing value is NULL, and on request also as CSV.

    Samples and attributes are stored before the classification reads them, so each is derived
    once; the CSV files are copies for people to read, which no later step parses.
    """
    combined, files, counts = read_combined(spark, paths), paths.silver_tables(), {}

    def store(name: str, df: DataFrame) -> DataFrame:
        counts[name] = write_parquet(blanks_to_null(df), files[name])
        table = spark.read.parquet(files[name])
        if text_copies:
            write_csv(table, paths.silver_csv()[name])
        return table.fillna("")

    store("sra_run", silver.silver_runs(combined["runs"]))
    samples = store("sra_sample", silver.silver_samples(combined["runs"]))
    attributes = store("sra_sample_attribute", silver.silver_attributes(combined["attributes"]))
    reference = (
        taxonomy.read_reference(spark, paths.taxonomy_reference)
        if newest_snapshot(spark, paths.taxonomy_reference) else None
    )
    store("sra_sample_classification", silver.classify_samples(samples, attributes, reference))
    return counts


def export_silver(spark: SparkSession, paths: LakePaths) -> dict[str, int]:
    """Silver CSV tables from elsewhere to the Parquet tables that gold reads."""
    files = paths.silver_csv()
    require(spark, files, "Silver CSV table")
    return {
        name: write_parquet(
            blanks_to_null(read_csv_strings(spark, path, schemas.SILVER[name])),
            paths.silver_tables()[name])
        for name, path in files.items()
    }


def build_gold(spark: SparkSession, paths: LakePaths) -> dict[str, int]:
    tables = _read_silver(spark, paths)
    facts = gold.sample_facts(
        tables["sra_sample_classification"], tables["sra_run"], tables["sra_sample_attribute"])
    # Written once, because two gold tables aggregate it.
    with stored(facts, "sample-facts") as once:
        return {
            name: write_parquet(df.coalesce(1), paths.gold_tables()[name])
            for name, df in gold.build_gold(tables, once).items()
        }


def register_views(spark: SparkSession, paths: LakePaths) -> list[str]:
    """Temporary views over the stored silver and gold tables, for ad-hoc SQL."""
    stored_tables = {**paths.silver_tables(), **paths.gold_tables()}
    found = {name: path for name, path in stored_tables.items() if exists(spark, path)}
    for name, path in found.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    return list(found)


def summarize(spark: SparkSession, paths: LakePaths) -> dict[str, int]:
    return summary.summarize_silver(_read_silver(spark, paths), paths.summary)


def validate(
    spark: SparkSession, paths: LakePaths,
    max_unknown_samples: int = quality.MAX_UNKNOWN_SAMPLES,
) -> DataFrame:
    """Write the quality report and return it as stored."""
    def read(path: str, columns: list[str]) -> DataFrame:
        if path.endswith(".csv"):
            return read_csv_strings(spark, path, columns)
        return spark.read.parquet(path)

    reference = newest_snapshot(spark, paths.taxonomy_reference) or paths.taxonomy_reference
    report = quality.validate_lake(
        spark, paths.silver_tables(), read, paths.gold_tables(), reference,
        paths.taxonomy_manifest, max_unknown_samples,
    )
    write_csv(report, paths.quality_report, single_file=True)
    return read_csv_strings(spark, paths.quality_report, schemas.QUALITY_CHECK)


def build_lake(
    spark: SparkSession, paths: LakePaths, dictionary_path: str | None = None,
    max_unknown_samples: int = quality.MAX_UNKNOWN_SAMPLES, text_copies: bool = False,
) -> dict:
    """Rebuild everything from the batch files; returns the counts of every step."""
    result: dict = {
        "bronze": combine(spark, paths, dictionary_path),
        "silver": build_silver(spark, paths, text_copies),
        "gold": build_gold(spark, paths),
        "summary": summarize(spark, paths),
    }
    checks = validate(spark, paths, max_unknown_samples)
    return {**result, "checks": checks, "passed": quality.gate(checks).first().passed}
