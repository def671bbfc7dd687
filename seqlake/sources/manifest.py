"""Append-only JSON manifests of what has been ingested.

A manifest of batches is a folder per job and range of offsets, so a job that runs for years reads only
the ranges that it touches, and folders that grew many small files can be compacted one by one. A
manifest from before the ranges, a flat folder of lines, is still read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlake import schemas
from seqlake.functions.text import utc_stamp
from seqlake.session import materialize
from seqlake.sources.files import delete, exists, matching_files

#: Offsets per folder of a manifest.
RANGE = 1_000_000
SCOPE = ["manifest_job", "offset_range"]
#: Folders that are looked up one by one; a reader of more takes all of them.
MAX_FOLDERS = 1000


def _lines(events: DataFrame) -> Column:
    return F.to_json(F.struct(*sorted(events.columns)))


def append_events(events: DataFrame, path: str) -> None:
    """Append one JSON line per event, with created_at added and keys in sorted order."""
    stamped = events.withColumn("created_at", utc_stamp())
    # Lines are few and small: let AQE pack them into few files, however many tasks made them.
    stamped.select(_lines(stamped).alias("value")).repartition("value") \
        .write.mode("append").text(path)


def _scope() -> list[Column]:
    # the job's digest, as its name may hold anything
    job = F.substring(F.sha2(F.coalesce("job_id", F.lit("")), 256), 1, 16)
    return [job.alias("manifest_job"),
            F.floor(F.coalesce("retstart", F.lit(0)) / RANGE).alias("offset_range")]


def append_batch_events(events: DataFrame, path: str) -> None:
    """Append events of batches, each to the folder of its job and range."""
    stamped = events.withColumn("created_at", utc_stamp())
    lines = stamped.select(*_scope(), _lines(stamped).alias("value"))
    lines.repartition(*SCOPE).write.mode("append").partitionBy(*SCOPE).text(path)


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST).option("mode", "FAILFAST").json(paths)


def _folder(path: str, job: str, offsets: str) -> str:
    return f"{path.rstrip('/')}/manifest_job={job}/offset_range={offsets}"


def read_manifest(spark: SparkSession, path: str, batches: DataFrame | None = None) -> DataFrame:
    """All events; an absent manifest has none. Blank lines are skipped.

    With `batches` (job_id, retstart) only the folders that can hold events of these are listed and
    read, whatever else the manifest holds: at most as many as there are batches.
    """
    empty = spark.createDataFrame([], schemas.MANIFEST)
    if not exists(spark, path):
        return empty
    flat = [p for s in matching_files(spark, path) + matching_files(spark, f"{path}/*") if s.isFile()
            and not (p := s.getPath().toString()).rsplit("/", 1)[1].startswith(("_", "."))]
    every = _folder(path, "*", "*")
    if batches is None:
        found = [every] if matching_files(spark, f"{path}/manifest_job=*") else []
    else:
        wanted = batches.select(*_scope()).distinct().limit(MAX_FOLDERS + 1).collect()
        if len(wanted) > MAX_FOLDERS:
            return read_manifest(spark, path)
        folders = [_folder(path, r.manifest_job, str(r.offset_range)) for r in wanted]
        found = [f for f in folders if exists(spark, f)]
    parts = [_read(spark, p) for p in (flat, found) if p]
    return reduce(DataFrame.unionAll, parts, empty) if len(parts) != 1 else parts[0]


def compact_manifest(spark: SparkSession, path: str, above: int = 8) -> int:
    """Rewrite the folders with more than `above` files as one file each; returns their number.

    The new file is written before the old ones go. A run that breaks off in between leaves events
    twice, which no reader minds: all of them look for distinct batches and ingestions. Not to be
    run beside an ingestion, which may be reading the old files.
    """
    folders: dict[str, list[str]] = {}
    for status in matching_files(spark, f"{_folder(path, '*', '*')}/part-*"):
        file = status.getPath().toString()
        folders.setdefault(file.rsplit("/", 1)[0], []).append(file)
    many = {folder: files for folder, files in folders.items() if len(files) > above}
    for folder, files in many.items():
        lines = materialize(spark.read.text(files).distinct(), "manifest")
        lines.coalesce(1).write.mode("append").text(folder)
        for file in files:
            delete(spark, file)
    return len(many)


def completed_offsets(events: DataFrame, *scope: str) -> DataFrame:
    """Distinct offsets of batches that succeeded, within each `scope` (such as job_id)."""
    return events.where(F.col("status") == "success").select(*scope, "retstart").distinct()


def read_ingested(spark: SparkSession, bronze: str, manifest: str, kind: str) -> DataFrame:
    """Bronze rows of every ingestion that the manifest confirms."""
    confirmed = (
        read_manifest(spark, manifest).where("status = 'success'").select("ingest_id").distinct()
    )
    return spark.read.parquet(f"{bronze}/{kind}").withColumn(
        "ingest_id", F.col("ingest_id").cast("string")).join(confirmed, "ingest_id", "left_semi")
