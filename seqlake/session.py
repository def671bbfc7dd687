"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Spark reads up to 4,096 rows of a Parquet row group at once, too much where a row is a whole payload:
#: tables of payloads are written with this option, in groups of few rows.
PAYLOAD_GROUPS = {"parquet.block.row.count.limit": "64"}
#: Whether a query deletes its shuffle files when it ends, and not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Written intermediate tables that are still there, by application.
_written: dict[str, list[str]] = {}


def build_session(app: str = "seqlake", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session may fall back to a folder of its own."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR)
    folder = folder or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"Set {CHECKPOINT_DIR} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="seqlake-"))
        folder = context.getCheckpointDir()
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/seqlake/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Tables that are written within the block take their shuffle files with them: later readers read
    the table."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage. It lasts as long
    as results may be derived from it: until `discard_scratch`, or the end of the program."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_parts(parts: list[DataFrame], label: str, **options: str) -> DataFrame:
    """`materialize` of one table in like parts, written one after the other and without their shuffle files."""
    spark, path = parts[0].sparkSession, scratch_path(parts[0].sparkSession, label)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    for df in parts:
        with shuffles_dropped(spark):
            df.write.mode("append").options(**options).parquet(path)
    return spark.read.schema(parts[0].schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def stored(df: DataFrame, label: str, **options: str) -> Iterator[DataFrame]:
    """A table that is written once, read within the block, and deleted after it."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    with shuffles_dropped(spark):
        df.write.options(**options).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


def discard_scratch(spark: SparkSession) -> None:
    """Delete every table that `materialize` wrote for this application."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


@atexit.register
def _discard_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _written:
        discard_scratch(spark)
