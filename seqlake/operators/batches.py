"""Row numbering, fixed-size batches and resumable batch windows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqlake.session import materialize, stored

WINDOWS_PER_BLOCK = 10_000


def with_row_index(df: DataFrame, order: list) -> DataFrame:
    """0-based global position in sort order, without sending the table through one task.

    The range-sorted table is written once, so that both the offsets and the rows see the same
    partitions; only one count per partition is summed up in a single window.
    """
    return _numbered(materialize(_sorted(df, order), "row-index"))


@contextmanager
def row_indexed(df: DataFrame, order: list) -> Iterator[DataFrame]:
    """`with_row_index` for a result that is used up within the block: the sorted table is deleted
    after it."""
    with stored(_sorted(df, order), "row-index", compression="zstd") as rows:
        yield _numbered(rows)


def _sorted(df: DataFrame, order: list) -> DataFrame:
    return df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id())


def _numbered(rows: DataFrame) -> DataFrame:
    partition = F.shiftright("__at", 33)
    sizes = rows.groupBy(partition.alias("__part")).agg(F.count("*").alias("__size"))
    preceding = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(preceding), F.lit(0)).alias("__offset")
    )
    within = F.col("__at").bitwiseAND((1 << 33) - 1)
    # One row per partition of the sort, hence small enough to broadcast.
    return (
        rows.withColumn("__part", partition)
        .join(F.broadcast(offsets), "__part")
        .withColumn("row_index", F.col("__offset") + within)
        .drop("__part", "__at", "__offset")
    )


def batch_ids(ids: DataFrame, column: str, size: int, order: list) -> DataFrame:
    """Ordered ids cut into groups of `size`: (batch_number, ids), numbered from 1."""
    if size <= 0:
        raise ValueError("batch size must be positive")
    numbered = with_row_index(ids.select(column), order)
    batch = F.floor(F.col("row_index") / size) + 1
    members = F.array_sort(F.collect_list(F.struct("row_index", column)))
    return (
        numbered.groupBy(batch.alias("batch_number")).agg(members.alias("m"))
        .select("batch_number", F.transform("m", lambda s: s[column]).alias("ids"))
    )


def batch_windows(totals: DataFrame, total: str, batch_size: int) -> DataFrame:
    """(…, batch_number, retstart, retmax) rows that cover `total` records of every input row.

    Windows are laid out in two steps so that no single row expands to an unbounded array.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    checked = F.when(F.col(total) < 0, F.raise_error("total_records must be non-negative")) \
        .otherwise(F.col(total)).cast("bigint")
    block = batch_size * WINDOWS_PER_BLOCK
    blocks = (
        totals.withColumn(total, checked).where(F.col(total) > 0)
        .withColumn("__block", F.explode(
            F.sequence(F.lit(0).cast("bigint"), F.col(total) - 1, F.lit(block).cast("bigint"))))
        .repartition(F.col("__block"))
    )
    block_end = F.least(F.col(total), F.col("__block") + block) - 1
    return (
        blocks.withColumn("retstart", F.explode(
            F.sequence(F.col("__block"), block_end, F.lit(batch_size).cast("bigint"))))
        .withColumn("retmax", F.least(F.lit(batch_size), F.col(total) - F.col("retstart")))
        .withColumn("batch_number", F.floor(F.col("retstart") / batch_size) + 1)
        .drop("__block", total)
    )


def pending_batches(windows: DataFrame, completed: DataFrame, on: list[str]) -> DataFrame:
    """Windows whose offset is not among the completed ones."""
    return windows.join(completed.select(*on).distinct(), on, "left_anti")
