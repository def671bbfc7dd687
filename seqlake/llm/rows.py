"""Small helpers that the operators share: Arrow-batched row functions and table access."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

import seqlake
from seqlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application, from the shared
    folder: they need not have it installed, nor share the driver's working directory."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(seqlake.__file__).parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'package')}.zip")
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(data.getvalue())
    stream.close()
    spark.sparkContext.addPyFile(target.toString())
    _shipped.add(application)


#: What a Python worker keeps from task to task of one stage, and that stage.
_kept: dict = {}
_kept_for: list[int | None] = [None]


def per_worker(key: tuple, make: Callable):
    """What `make()` builds, once per Python worker and stage. A worker serves tasks of many stages;
    what one stage keeps must not be held through the others."""
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def _enter_stage() -> None:
    context = TaskContext.get()
    stage = context.stageId() if context else None
    if stage != _kept_for[0]:
        _kept.clear()
        _kept_for[0] = stage


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of an Arrow batch, at most: with Spark's 10,000, batches of texts take tens of MB on either side
#: of every running Python worker.
BATCH_ROWS = 1_000


def map_arrow(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """`mapInArrow` with the package on the workers. Lowers the session's rows per Arrow batch to
    BATCH_ROWS, as plans take the setting when they run."""
    spark = df.sparkSession
    ship_package(spark)
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))

    def in_stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _enter_stage()
        yield from run(batches)

    return df.mapInArrow(in_stage, schema)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def map_rows(df: DataFrame, schema: str, start: Callable[[], Callable]) -> DataFrame:
    """`start()` runs once per task and returns a function from the columns of an Arrow batch (as
    lists) to the columns of `schema` (lists or arrays of any common length)."""
    struct = _parse_datatype_string(schema)
    assert isinstance(struct, StructType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(struct)
        step = start()
        for batch in batches:
            # a few hundred rows at a time bound the Python objects, whatever the batch size
            for at in range(0, batch.num_rows, 512):
                columns = step(*(c.to_pylist() for c in batch.slice(at, 512).columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, target, strict=True)],
                    schema=target)

    return map_arrow(df, run, struct)


def map_groups(df: DataFrame, key: str, schema: str, work: Callable, partitions: int) -> DataFrame:
    """`work(rows)` for the rows (dicts) of each key, yielding tuples of `schema`. Keys are dealt
    out by hash, sorted in each task and read as runs; only one key's rows are held at a time, so
    keys must be bounded by their maker."""
    struct = _parse_datatype_string(schema)
    assert isinstance(struct, StructType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(struct)

        def flush(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[] for _ in target]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

        held: list[dict] = []
        out: list[tuple] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for row in batch.slice(at, 512).to_pylist():
                    if held and row[key] != held[0][key]:
                        out.extend(work(held))
                        held = []
                    held.append(row)
                if len(out) > 4096:
                    yield flush(out)
                    out = []
        if held:
            out.extend(work(held))
        yield flush(out)

    return map_arrow(df.repartition(partitions, key).sortWithinPartitions(key), run, struct)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
