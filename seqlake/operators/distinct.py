"""Exact distinct counts that add up: bitmaps over numbered values.

`number_values` gives every distinct value a number once and for all; later values get numbers after
those, so numbers are stable over snapshots. The state of a group is one row per 64 numbers with
a bit per value seen. States of snapshots, partitions or tasks merge with a bitwise or, and the count
is the number of bits, exact however often a value occurs in how many snapshots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlake.operators.skew import lookup_join
from seqlake.session import materialize

WORD = 64


def number_values(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(column, number) of the known values, unchanged, and of the distinct values beyond them.

    Numbers run on within a task and leave gaps between tasks, which costs no global sort; a gap
    holds no words, so it takes no room in a state.
    """
    fresh = values.select(column).where(F.col(column).isNotNull()).distinct()
    if known is None:
        return materialize(
            fresh.withColumn("number", F.monotonically_increasing_id()), "numbered-values")
    top = known.agg(F.coalesce(F.max("number"), F.lit(-1)).alias("top"))
    # the next free word, so that snapshots do not share words for want of a reason
    start = F.expr(f"((top + {WORD}) div {WORD}) * {WORD}")
    added = fresh.join(known.select(column), column, "left_anti") \
        .withColumn("number", F.monotonically_increasing_id() + top.select(start).scalar())
    return materialize(known.select(column, "number").unionByName(added), "numbered-values")


def distinct_state(
    rows: DataFrame, groups: list[str], column: str, numbers: DataFrame
) -> DataFrame:
    """groups, word, bits: the numbered values that each group has. NULL is no value."""
    seen = rows.where(F.col(column).isNotNull()).select(*groups, column).distinct()
    coded = lookup_join(seen, numbers, column, groups).withColumns({
        "word": F.expr(f"number div {WORD}"),
        "bit": F.expr(f"shiftleft(1L, cast(number % {WORD} as int))")})
    return coded.groupBy(*groups, "word").agg(F.bit_or("bit").alias("bits"))


def merge_states(states: DataFrame, groups: list[str]) -> DataFrame:
    """One state from the stacked states of several snapshots."""
    return states.groupBy(*groups, "word").agg(F.bit_or("bits").alias("bits"))


def count_state(state: DataFrame, groups: list[str], name: str) -> DataFrame:
    return state.groupBy(*groups).agg(F.sum(F.bit_count("bits").cast("bigint")).alias(name))
