"""A log of committed snapshots beside the tables it names.

Each commit is one small file, numbered without gaps and created only if no such number exists
(where the file system can say so; HDFS and the common object-store connectors do). Whoever loses a
race takes the next number. A snapshot is what the log says: a write that broke off is in no entry,
and an entry that was not finished is passed over. Modification times play no part.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from seqlake.sources.files import matching_files

LOG = "_snapshots"
ATTEMPTS = 20


def _entries(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Numbers and paths of all entries, the newest first."""
    found = [s.getPath().toString() for s in
             matching_files(spark, f"{folder.rstrip('/')}/{LOG}/[0-9]*.json")]
    return sorted(((int(p.rsplit("/", 1)[1].removesuffix(".json")), p) for p in found), reverse=True)


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist; False if it does."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    try:
        stream = system.create(target, False)
    except Exception as error:  # noqa: BLE001 - py4j wraps the Java exception
        if "AlreadyExists" in str(error) or "already exists" in str(error):
            return False
        raise
    stream.write(text.encode())
    stream.close()
    return True


def _read(spark: SparkSession, path: str) -> dict | None:
    rows = spark.read.text(path, wholetext=True).collect()
    try:
        entry = json.loads(rows[0].value) if rows else None
    except json.JSONDecodeError:
        return None
    return entry if isinstance(entry, dict) and "tables" in entry else None


def commit_snapshot(spark: SparkSession, folder: str, tables: dict[str, str]) -> int:
    """Record that the tables (name: path) are whole and belong together; returns the number."""
    stamp = datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ")
    for _ in range(ATTEMPTS):
        number = next((n for n, _ in _entries(spark, folder)), 0) + 1
        entry = {"created_at": stamp, "number": number, "tables": tables}
        path = f"{folder.rstrip('/')}/{LOG}/{number:012d}.json"
        if _create(spark, path, json.dumps(entry, sort_keys=True)):
            return number
    raise RuntimeError(f"Could not append to the snapshot log of {folder}: too many writers")


def snapshots(spark: SparkSession, folder: str) -> Iterator[dict]:
    """Finished entries, the newest first; they are read only as far as they are asked for."""
    for _, path in _entries(spark, folder):
        entry = _read(spark, path)
        if entry is not None:
            yield entry


def newest_tables(spark: SparkSession, folder: str) -> dict[str, str] | None:
    """Paths of the newest committed snapshot's tables; None where nothing was committed."""
    return next((e["tables"] for e in snapshots(spark, folder)), None)
