"""Equi joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEY_ROWS = 1_000_000
NO_KEY_SALTS = 1024
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_CHARS = 32_000_000


def salted_join(
    fact: DataFrame, dim: DataFrame, key: str, spread_by: list[str],
    how: str = "inner", hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Join where keys with more than `hot_rows` fact rows are split over several tasks.

    The list of hot keys has at most (fact rows / hot_rows) entries, which bounds the broadcast.
    Only the dimension rows of hot keys are repeated, once per salt.
    """
    hot = F.broadcast(
        fact.where(F.col(key).isNotNull())
        .groupBy(key).agg(F.count("*").alias("__rows"))
        .where(F.col("__rows") > hot_rows)
        .select(key, F.ceil(F.col("__rows") / hot_rows).cast("int").alias("__salts"))
    )
    salts = F.coalesce("__salts", F.lit(1))
    # Rows without a key match nothing, so they may go anywhere.
    fact_salts = F.when(F.col(key).isNull(), NO_KEY_SALTS).otherwise(salts)
    salted_fact = fact.join(hot, key, "left").withColumn(
        "__salt", F.pmod(F.xxhash64(*spread_by), fact_salts).cast("int")
    )
    salted_dim = dim.join(hot, key, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    joined = salted_fact.drop("__salts").join(salted_dim.drop("__salts"), [key, "__salt"], how)
    return joined.drop("__salt")


def lookup_join(
    fact: DataFrame, dim: DataFrame, key: str, spread_by: list[str],
    max_rows: int = MAX_BROADCAST_ROWS, hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Left join to a reference table: broadcast when it is measured and small, salted beyond."""
    if is_small(dim, max_rows):
        return fact.join(F.broadcast(dim), key, "left")
    return salted_join(fact, dim, key, spread_by, "left", hot_rows)


def is_small(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    width = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in dim.columns]))
    size = dim.agg(F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("chars")).first()
    return size["rows"] <= max_rows and size["chars"] <= MAX_BROADCAST_CHARS


def key_or_spread(key: str, spread_by: str) -> Column:
    """The key, or for rows without one a value that matches nothing and differs by row.

    Left joins would otherwise send all rows without a key to a single task.
    """
    unmatched = F.concat(F.lit("\u0000"), F.coalesce(F.col(spread_by), F.lit("")))
    return F.when(F.coalesce(F.col(key), F.lit("")) != "", F.col(key)).otherwise(unmatched)
