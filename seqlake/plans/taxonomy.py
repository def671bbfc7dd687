"""Taxonomy reference: which ids are missing, and the merge of newly landed entries."""

from __future__ import annotations

from contextlib import ExitStack
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlake import schemas
from seqlake.functions.text import is_blank, null_to_blank, strip
from seqlake.operators.batches import batch_ids
from seqlake.operators.dedupe import keep_last, upsert
from seqlake.session import stored
from seqlake.sources.files import (
    newest_snapshot, project_fields, read_csv_strings, write_snapshot,
)
from seqlake.sources.manifest import append_events
from seqlake.sources.payloads import taxonomy_rows


def unique_taxon_ids(samples: DataFrame) -> DataFrame:
    return (
        samples.select(strip(null_to_blank(F.col("taxon_id"))).alias("taxon_id"))
        .where("taxon_id <> ''").distinct()
    )


def dimension(rows: DataFrame) -> DataFrame:
    """One row per id out of stored rows: the last one in `row_order` counts."""
    named = rows.where(~is_blank(F.col("taxon_id")))
    return project_fields(keep_last(named, ["taxon_id"]), schemas.TAXONOMY)


def numeric_order(c: str = "taxon_id") -> list[Column]:
    """Numeric ids by value, everything else behind them."""
    number = F.when(F.col(c).rlike("^[0-9]+$"), F.expr(f"try_cast({c} AS decimal(38,0))"))
    return [F.coalesce(number, F.lit(10**12).cast("decimal(38,0)")), F.col(c)]


def missing_ids(samples: DataFrame, reference: DataFrame | None) -> DataFrame:
    """Sample taxon ids that the reference lacks, in numeric order."""
    ids = unique_taxon_ids(samples)
    if reference is not None:
        ids = ids.join(reference.select("taxon_id"), "taxon_id", "left_anti")
    return ids.orderBy(*numeric_order())


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot of the reference at `path`; later files and rows count."""
    rows = read_csv_strings(
        spark, newest_snapshot(spark, path) or path, schemas.TAXONOMY, "*", with_source=True)
    return dimension(rows)


def write_reference(reference: DataFrame, path: str) -> str:
    """A new snapshot, sorted by id; readers see it once it is complete."""
    return write_snapshot(
        project_fields(reference, schemas.TAXONOMY).orderBy(*numeric_order()), path)


@dataclass(frozen=True)
class TaxonomyUpdate:
    input_taxon_ids: int
    existing_taxon_ids: int
    fetched_taxon_ids: int
    output_taxon_ids: int
    batch_count: int


def request_batches(samples: DataFrame, reference: DataFrame | None, size: int) -> DataFrame:
    """The missing ids cut into request batches of `size`, in numeric order."""
    return batch_ids(missing_ids(samples, reference), "taxon_id", size, numeric_order())


def update_counts(
    samples: DataFrame, existing: DataFrame, fetched: DataFrame
) -> DataFrame:
    """One row with the input, existing, fetched and output id counts, in one aggregation."""
    def tagged(df: DataFrame, tag: str) -> DataFrame:
        return df.select("taxon_id", F.lit(tag).alias("tag"))

    tags = (
        tagged(unique_taxon_ids(samples), "input").unionAll(tagged(existing, "existing"))
        .unionAll(tagged(fetched, "fetched"))
        .groupBy("taxon_id").agg(*[
            F.bool_or(F.col("tag") == tag).alias(tag) for tag in ("input", "existing", "fetched")])
    )
    return tags.agg(
        F.count_if("input").alias("input_taxon_ids"),
        F.count_if("existing").alias("existing_taxon_ids"),
        F.count_if("fetched").alias("fetched_taxon_ids"),
        F.count_if(F.col("existing") | F.col("fetched")).alias("output_taxon_ids"),
    )


def update_reference(
    spark: SparkSession, samples: DataFrame, landed: DataFrame, path: str, manifest: str,
    rebuild: bool = False, order: str = "source_path",
) -> TaxonomyUpdate:
    """Merge landed taxonomy payloads into the reference at `path` and record the update.

    Only ids that samples use and the reference lacks are needed; payloads for them are expected
    in `landed`. With `rebuild` the existing reference is ignored.
    """
    keep = newest_snapshot(spark, path) is not None and not rebuild
    blank = spark.createDataFrame([], schemas.strings(schemas.TAXONOMY))
    with ExitStack() as tables:
        once = lambda df: tables.enter_context(stored(df, "taxonomy"))
        existing = once(read_reference(spark, path)) if keep else blank
        wanted = missing_ids(samples, existing)
        requested = wanted.count()
        fetched = once(taxonomy_rows(landed, order)) if requested else blank
        merged = once(upsert(existing, fetched, "taxon_id"))
        counts = update_counts(samples, existing, fetched).first()
        written = write_reference(merged, path)
    event = {
        "status": "success" if requested else "noop",
        "requested_taxon_ids": requested,
        "fetched_taxon_ids": counts.fetched_taxon_ids,
        "output_path": written,
        "rebuild": rebuild,
    }
    append_events(spark.createDataFrame([event]), manifest)
    batches = landed.count() if requested else 0
    return TaxonomyUpdate(**counts.asDict(), batch_count=batches)
