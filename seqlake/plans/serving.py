"""Serving: the gold tables with their published types and column order, and where they go."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlake.schemas import GOLD
from seqlake.sources.files import read_tables


def serving_table(name: str, gold: Mapping[str, DataFrame]) -> DataFrame:
    return gold[name].select(*[F.col(c).cast(kind).alias(c) for c, kind in GOLD[name].items()])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every table, stacked."""
    counted = [
        df.agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def _counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    return {row.table_name: row.row_count for row in row_counts(tables).collect()}


LOAD, POINTER = "load_id", "published_loads"
#: Loads that stay readable: the published one and the one before, which readers may still be on.
KEPT_LOADS = 2


def _load_table(loads: str, name: str) -> str:
    return f"`{loads}`.`{name}_by_load`"


def _stage_load(gold: Mapping[str, DataFrame], loads: str, load: str) -> dict[str, int]:
    """Add the tables' rows under a load id that nobody reads yet, and check their counts."""
    for name in GOLD:
        serving_table(name, gold).withColumn(LOAD, F.lit(load)).write.mode("append") \
            .partitionBy(LOAD).saveAsTable(_load_table(loads, name))
    spark = next(iter(gold.values())).sparkSession
    counts = _counts({
        name: spark.table(_load_table(loads, name)).where(F.col(LOAD) == load) for name in GOLD})
    if counts != _counts(gold):
        raise ValueError(f"The load {load} is incomplete; nothing was published")
    return counts


def _view_text(loads: str, name: str) -> str:
    columns = ", ".join(f"`{c}`" for c in GOLD[name])
    return (f"SELECT {columns} FROM {_load_table(loads, name)} WHERE {LOAD} = "
            f"(SELECT max({LOAD}) FROM `{loads}`.`{POINTER}`)")


def _ensure_views(spark: SparkSession, schema: str, loads: str) -> None:
    """The published names, all of which read the load that the pointer names."""
    stored = {t.name: t.tableType for t in spark.catalog.listTables(schema) if not t.isTemporary}
    mark = f"{schema}.pointer"
    for name in GOLD:
        kind = stored.get(name)
        if kind == "VIEW":
            marks = spark.sql(f"SHOW TBLPROPERTIES `{schema}`.`{name}`").collect()
            if any(r["key"] == mark for r in marks):
                continue
        elif kind is not None:  # published before there were loads
            spark.sql(f"DROP TABLE `{schema}`.`{name}`")
        spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{name}` TBLPROPERTIES ('{mark}' = '1') "
                  f"AS {_view_text(loads, name)}")


def _commit_load(spark: SparkSession, loads: str, load: str) -> None:
    """The one step that publishes: a single row, in a single file that appears when it is whole."""
    spark.createDataFrame([(load,)], f"{LOAD} string").coalesce(1) \
        .write.mode("append").saveAsTable(f"`{loads}`.`{POINTER}`")


def _drop_old_loads(spark: SparkSession, loads: str, load: str) -> None:
    """Drop loads before the last published ones, and earlier ones that were never published."""
    published = [r[0] for r in spark.table(f"`{loads}`.`{POINTER}`").where(F.col(LOAD) <= load)
                 .orderBy(F.desc(LOAD)).limit(KEPT_LOADS).collect()]
    for name in GOLD:
        table = _load_table(loads, name)
        found = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        for old in found:
            if old < load and old not in published:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({LOAD} = '{old}')")


def publish_to_catalog(
    spark: SparkSession, gold_folder: str, schema: str = "gold_sra"
) -> dict[str, int]:
    """Publish all gold tables of `schema` as one change; returns the row count of each.

    A load first adds its rows to the tables of `<schema>_loads` under an id of its own and checks
    their counts. The six published views read whatever load the pointer names, and one row added to
    the pointer publishes all six at once: whoever reads between two steps, or after a load that
    broke off at any of them, sees the load before in every view. Only views from before the
    pointer are replaced one by one, after the first load that has one.
    """
    gold = read_tables(spark, gold_folder, list(GOLD), "Gold Parquet table")
    loads, load = f"{schema}_loads", datetime.now(UTC).strftime("%Y%m%dT%H%M%S%fZ")
    for needed in (schema, loads):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{needed}`")
    counts = _stage_load(gold, loads, load)
    _commit_load(spark, loads, load)
    _ensure_views(spark, schema, loads)
    _drop_old_loads(spark, loads, load)
    return counts


def publish_to_database(
    spark: SparkSession, gold_folder: str, url: str, properties: dict[str, str],
    schema: str = "gold_sra",
) -> dict[str, int]:
    """Truncate and reload the database tables over JDBC, keeping their definitions.

    Each table is one small write. JDBC has no transaction across tables: a reader may see old
    and new tables side by side while the load runs.
    """
    gold = read_tables(spark, gold_folder, list(GOLD), "Gold Parquet table")
    for name in GOLD:
        serving_table(name, gold).coalesce(1).write.option("truncate", True).mode("overwrite").jdbc(
            url, f"{schema}.{name}", properties=properties)
    return _counts(gold)
