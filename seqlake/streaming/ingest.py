"""Resumable ingestion of landed XML batches into bronze, as a batch job or a stream.

A landed batch is a row (job_id, batch_number, retstart, retmax, body). Each attempt writes its
rows below an ingest_id of its own and then records its batches in the manifest. Readers see only
rows that the manifest confirms: a job that dies half way leaves nothing visible, and running it
again redoes only what is missing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqlake.functions.text import path_parts
from seqlake.operators.attributes import categorize, normalize_names
from seqlake.operators.batches import batch_windows, pending_batches
from seqlake.operators.skew import MAX_BROADCAST_ROWS
from seqlake.schemas import LANDING
from seqlake.session import PAYLOAD_GROUPS, stored
from seqlake.sources.manifest import append_batch_events, completed_offsets, read_manifest
from seqlake.sources.payloads import (
    parse_packages, run_records, sample_attributes, search_history, search_ids,
)

BATCH_KEY = ["job_id", "retstart"]
BATCHES = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("batch_number", T.LongType()),
    T.StructField("retstart", T.LongType()),
    T.StructField("retmax", T.LongType()),
    T.StructField("body", T.StringType()),
])
#: What a batch may say about itself beside that: the search it belongs to and its landed file.
ORIGIN = ["query", "raw_xml_path"]


class IngestError(ValueError):
    """A landed batch could not be parsed; the manifest has the details."""


def _counted(parsed: DataFrame) -> DataFrame:
    """Row counts beside the packages, so that events need not read the packages again."""
    runs = F.aggregate(
        "packages", F.lit(0).cast("bigint"),
        lambda n, p: n + F.greatest(F.coalesce(F.size(p["RUN_SET"]["RUN"]), F.lit(0)), F.lit(1)))
    attributes = F.aggregate(
        "packages", F.lit(0).cast("bigint"),
        lambda n, p: n + F.greatest(F.coalesce(
            F.size(p["SAMPLE"]["SAMPLE_ATTRIBUTES"]["SAMPLE_ATTRIBUTE"]), F.lit(0)), F.lit(0)))
    good = F.col("parse_error").isNull()
    return parsed.withColumns({
        "run_rows": F.when(good, F.coalesce(runs, F.lit(0))),
        "sample_attribute_rows": F.when(good, F.coalesce(attributes, F.lit(0))),
    })


def _events(parsed: DataFrame, bronze: str, ingest_id: str) -> DataFrame:
    good = F.col("parse_error").isNull()
    wrote = lambda kind: F.when(good, F.lit(f"{bronze}/{kind}/ingest_id={ingest_id}"))
    return parsed.select(
        F.when(good, "success").otherwise("failure").alias("status"),
        "job_id", "batch_number", "retstart", "retmax", "run_rows", "sample_attribute_rows",
        *ORIGIN, wrote("runs").alias("bronze_path"),
        wrote("attributes").alias("sample_attributes_path"), F.lit(ingest_id).alias("ingest_id"),
        F.when(~good, F.lit("payload is not well-formed XML")).alias("error"),
    )


@contextmanager
def _pending(landed: DataFrame, manifest: str) -> Iterator[tuple[DataFrame, int]]:
    """Landed batches that are not done, one row per batch, and how many batches have landed.

    Only keys meet the manifest, of which only the folders of these keys are read. A payload is
    known by its key and digest, which are the same however often and in whatever order the landed
    files are read; where copies of one have landed, the copies alone are made distinct. The payloads
    to parse are named by a broadcast while they are few."""
    spark = landed.sparkSession
    payload = ["__body", "batch_number", "retmax"]
    known = landed.withColumn("__body", F.xxhash64("body"))
    counted = known.groupBy(*BATCH_KEY, *payload).agg(F.count("*").alias("__copies"))
    first = counted.groupBy(*BATCH_KEY).agg(F.min(F.struct(*payload, "__copies")).alias("__pick"))
    with stored(first, "landed-batches", compression="zstd") as keys:
        events = read_manifest(spark, manifest, keys)
        done = completed_offsets(events, "job_id").withColumn("__done", F.lit(True))
        seen = keys.join(done, BATCH_KEY, "left")
        open_ = F.col("__done").isNull()
        totals = seen.agg(
            F.count("*").alias("landed"), F.count("__done").alias("done"),
            F.max(F.when(open_, F.col("__pick.__copies"))).alias("copies")).first()
        picked = seen.where(open_).select(
            *[F.col(c).alias(f"__{c}") for c in BATCH_KEY], "__pick")
        if totals.landed - totals.done <= MAX_BROADCAST_ROWS:
            picked = F.broadcast(picked)
        same = [known[c].eqNullSafe(picked[f"__{c}"]) for c in BATCH_KEY] + [
            known[c].eqNullSafe(picked["__pick"][c]) for c in payload]
        pending = known.join(picked, same)
        several = F.col("__pick.__copies") > 1
        one = pending.where(~several)
        if (totals.copies or 0) > 1:
            one = one.unionByName(pending.where(several).dropDuplicates(BATCH_KEY))
        yield one.select(*landed.columns), totals.landed


def project_origin(landed: DataFrame) -> DataFrame:
    """Batches with the columns of ORIGIN, NULL where they were not given."""
    return landed.withColumns({
        c: F.lit(None).cast("string") for c in ORIGIN if c not in landed.columns})


def ingest_batches(
    landed: DataFrame, bronze: str, manifest: str, label: str, dictionary: DataFrame,
    quarantine: bool = False,
) -> dict[str, int]:
    """Parse the batches the manifest does not list as done; returns what was done and skipped.

    Well-formed batches are kept even when others are not. Failed ones are recorded in the manifest
    and in the quarantine table (key and error); then an IngestError is raised, or with `quarantine`
    the caller finds their number in the result. A batch that lands again, mended, is ingested.
    Every attempt writes below an id of its own, so that repeating one never touches confirmed rows.
    """
    ingest_id = f"{label}-{uuid.uuid4().hex}"
    landed = project_origin(landed)
    keep = ["job_id", "batch_number", "retstart"]
    with _pending(landed, manifest) as (pending, batches), \
            stored(_counted(parse_packages(pending).drop("body")), "parsed",
                   compression="zstd", **PAYLOAD_GROUPS) as parsed:
        # Written once: both bronze tables and the manifest read the parsed packages.
        good = parsed.where("parse_error IS NULL")
        attributes = categorize(
            normalize_names(sample_attributes(good, keep)), dictionary,
            ["sample_accession", "attribute_value"])
        for kind, rows in {"runs": run_records(good, keep), "attributes": attributes}.items():
            rows.write.option("compression", "zstd").parquet(f"{bronze}/{kind}/ingest_id={ingest_id}")
        events = _events(parsed, bronze, ingest_id)
        append_batch_events(events, manifest)
        totals = events.agg(
            F.count_if(F.col("status") == "success").alias("completed_batches"),
            F.count_if(F.col("status") == "failure").alias("failed_batches"),
            F.coalesce(F.sum("run_rows"), F.lit(0)).alias("run_rows"),
            F.coalesce(F.sum("sample_attribute_rows"), F.lit(0)).alias("sample_attribute_rows"),
        ).first().asDict()
        failed = totals["failed_batches"]
        if failed:
            events.where("status = 'failure'").select(*BATCH_KEY, "batch_number", "error") \
                .write.parquet(f"{bronze}/quarantine/ingest_id={ingest_id}")
    if failed and not quarantine:
        raise IngestError(f"{failed} landed batches could not be parsed, see {manifest}")
    return {**totals, "skipped_batches": batches - totals["completed_batches"] - failed}


def plan_fetches(
    searches: DataFrame, events: DataFrame, batch_size: int, max_records: int | None = None
) -> DataFrame:
    """Batches still to be fetched: windows over each job's search result, minus finished ones.

    `searches` holds (job_id, body) with one search response per job. A response without history
    handles is an error, since its records could not be fetched.
    """
    if max_records is not None and max_records <= 0:
        raise ValueError("max_records must be positive when provided")
    found = search_history(searches, ["job_id"])
    target = F.col("count") if max_records is None else F.least("count", F.lit(max_records))
    handled = (F.col("query_key") != "") & (F.col("webenv") != "")
    total = F.when(handled, target).otherwise(
        F.raise_error(F.lit("Search did not return history handles")).cast("bigint"))
    windows = batch_windows(
        found.select("job_id", "query_key", "webenv", total.alias("total")), "total", batch_size)
    return pending_batches(windows, completed_offsets(events, "job_id"), BATCH_KEY)


def landed_batches(landed: DataFrame) -> DataFrame:
    """The fetched payloads of a landing table as batches. The job is the folder a payload landed
    in; offset and size are the ones it was requested with."""
    offset = F.col("params")["retstart"].cast("bigint")
    size = F.col("params")["retmax"].cast("bigint")
    return landed.where((F.col("utility") == "efetch") & offset.isNotNull()).select(
        F.element_at(path_parts(F.col("source_path")), -2).alias("job_id"),
        (F.floor(F.try_divide(offset, size)) + 1).alias("batch_number"),
        offset.alias("retstart"), size.alias("retmax"), "body",
        F.col("params")["term"].alias("query"), F.col("source_path").alias("raw_xml_path"),
    )


def ingest_stream(
    spark: SparkSession, landing: str, bronze: str, manifest: str, checkpoint: str,
    dictionary: DataFrame, max_files: int = 1000, schema: T.StructType = BATCHES,
) -> None:
    """Ingest every landed file that has not been seen yet, then stop.

    The files hold batches, or raw responses when `schema` is the landing schema. A micro-batch
    that is replayed after a failure finds in the manifest what it had finished. Payloads that
    cannot be parsed go to quarantine and do not hold up what lands after them; if there were any,
    an IngestError is raised once everything has been seen.
    """
    failed = 0

    def write(arrived: DataFrame, epoch: int) -> None:
        nonlocal failed
        batches = landed_batches(arrived) if schema == LANDING else arrived
        failed += ingest_batches(
            batches, bronze, manifest, f"epoch-{epoch:09d}", dictionary, quarantine=True,
        )["failed_batches"]

    query = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(landing)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if failed:
        raise IngestError(f"{failed} landed batches could not be parsed, see {manifest}")


def preview(
    search: DataFrame, fetched: DataFrame, retmax: int = 3
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A small discovery run: up to `retmax` ids, and the rows of the payloads fetched for them."""
    parsed = parse_packages(fetched)
    return search_ids(search).limit(retmax), run_records(parsed), sample_attributes(parsed)
