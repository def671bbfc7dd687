"""Bronze: many overlapping query batches merged into one run table and one attribute table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlake import schemas
from seqlake.functions.text import path_parts
from seqlake.operators.attributes import categorize, normalize_names
from seqlake.operators.dedupe import ORDER, merge_duplicates
from seqlake.session import materialize
from seqlake.sources.files import NoInputError, exists, read_bronze_batches
from seqlake.sources.manifest import read_ingested

RUN_PATTERN = "sra-bronze-batch-*.csv"
ATTRIBUTE_PATTERN = "sra-sample-attributes-batch-*.csv"


def source_path_order() -> list[Column]:
    """Sources of scanned CSV files appear in path order."""
    return [F.col(f"{ORDER}.path")]


def combine_runs(runs: DataFrame, source_order: list[Column] | None = None) -> DataFrame:
    return merge_duplicates(runs, schemas.RUN_KEY, source_order or source_path_order())


def combine_attributes(
    attributes: DataFrame, dictionary: DataFrame, source_order: list[Column] | None = None
) -> DataFrame:
    """Merge on the recomputed name; the category, a function of it, is set on what remains."""
    merged = merge_duplicates(
        normalize_names(attributes), schemas.ATTRIBUTE_KEY, source_order or source_path_order()
    )
    return categorize(merged, dictionary, ["sample_accession", "attribute_value"])


def combine_files(
    spark: SparkSession, folder: str, pattern: str, columns: list[str], keys: list[str],
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Merge any set of batch files, with an optional transformation of the scanned rows."""
    rows = read_bronze_batches(spark, folder, pattern, columns)
    changed = rows.transform(transform) if transform else rows
    # the merge reads keys, sources and whole rows apart: CSV is parsed once for all of them
    return merge_duplicates(materialize(changed, "batch-rows"), keys, source_path_order())


def ingested_rows(spark: SparkSession, folder: str, manifest: str, kind: str, root: str) -> DataFrame:
    """Ingested batches with the lineage and order that their batch files below `root` would have."""
    prefix, position = {
        "runs": ("sra-bronze-batch", "run_index"),
        "attributes": ("sra-sample-attributes-batch", "attribute_index"),
    }[kind]
    rows = read_ingested(spark, folder, manifest, kind)
    file = F.format_string(f"{prefix}-%06d.csv", "batch_number")
    # Packages keep their order in the payload, and rows their order in the package.
    at = F.col("package_index").cast("bigint") * (1 << 31) + F.coalesce(position, F.lit(0))
    columns = {"runs": schemas.BRONZE_RUN, "attributes": schemas.BRONZE_ATTRIBUTE}[kind]
    return rows.withColumns({
        "source_dataset": F.col("job_id"),
        "source_file": file,
        ORDER: F.struct(
            F.concat(path_parts(F.lit(root.rstrip("/"))), F.array("job_id", file)).alias("path"),
            at.alias("row")),
    }).select(*schemas.LINEAGE, *columns, ORDER)


def combine_batches(
    spark: SparkSession, folder: str, dictionary: DataFrame,
    ingested: str | None = None, manifest: str | None = None,
) -> dict[str, DataFrame]:
    """Merge the batch files below `folder` and the ingested batches, whichever there are."""
    def rows(kind: str, pattern: str, columns: list[str]) -> DataFrame:
        parts = []
        if ingested and exists(spark, ingested):
            parts.append(ingested_rows(spark, ingested, manifest, kind, folder))
        try:
            parts.append(read_bronze_batches(spark, folder, pattern, columns))
        except NoInputError:
            if not parts:
                raise
        # the merge reads keys, sources and whole rows apart: input is parsed once for all of them
        return materialize(reduce(DataFrame.unionByName, parts), f"batch-{kind}")

    runs = rows("runs", RUN_PATTERN, schemas.BRONZE_RUN)
    attributes = rows("attributes", ATTRIBUTE_PATTERN, schemas.BRONZE_ATTRIBUTE)
    return {"runs": combine_runs(runs), "attributes": combine_attributes(attributes, dictionary)}
