"""CSV and Parquet tables: all-string scans with lineage, and the matching writers."""

from __future__ import annotations

import csv
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from seqlake import schemas
from seqlake.functions.text import blank_to_null, file_name, path_parts, source_dataset_name
from seqlake.operators.dedupe import ORDER
from seqlake.sources.csv_split import read_split_csv


class NoInputError(ValueError):
    """No file matches what was asked for."""


def matching_files(spark: SparkSession, pattern: str) -> list:
    """File status of each path that matches a glob, on whichever file system it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or [])


def exists(spark: SparkSession, path: str) -> bool:
    return bool(matching_files(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def require(spark: SparkSession, paths: dict[str, str], what: str) -> None:
    for path in paths.values():
        if not exists(spark, path):
            raise ValueError(f"Missing required {what}: {path}")


def latest_matching(spark: SparkSession, folder: str, pattern: str) -> str:
    """The most recently modified file or whole table folder in `folder` that matches `pattern`."""
    found = [s for s in matching_files(spark, f"{folder.rstrip('/')}/{pattern}")
             if s.isFile() or exists(spark, f"{s.getPath().toString()}/_SUCCESS")]
    if not found:
        raise NoInputError(f"No files matched {pattern} in {folder}")
    newest = max(found, key=lambda status: status.getModificationTime())
    return newest.getPath().toString()


#: CSV files above this size are read by several tasks each.
SPLIT_ABOVE = 256 * 1024 * 1024


def _file_path() -> Column:
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_csv_strings(
    spark: SparkSession, path: str, columns: list[str],
    pattern: str | None = None, with_source: bool = False, paths: list[str] | None = None,
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """CSV with a header as text columns; quoted line breaks are kept; a missing value is ''.

    With `with_source`, files below `path` are read recursively and every row gets
    source_dataset, source_file and `row_order`; `paths` then limits the scan to some of the files
    and folders below `path`. A header that differs from `columns` is an error. Files up to
    `split_above` bytes are read by one task each, larger ones block by block.
    """
    def scan(reader: DataFrameReader) -> DataFrameReader:
        return reader if pattern is None else reader.option(
            "recursiveFileLookup", True).option("pathGlobFilter", pattern)

    where = path if paths is None else paths
    size = F.col("_metadata.file_size")
    reader = (
        scan(spark.read).schema(schemas.strings(columns))
        .option("header", True).option("enforceSchema", False)
        .option("escape", '"').option("multiLine", True)
    )
    # A multi-line file is never split here: within a file the running id follows the rows.
    rows = reader.csv(where).where(size <= split_above).select(
        _file_path().alias("__path"), F.monotonically_increasing_id().alias("__row"), *columns)
    listed = scan(spark.read.format("binaryFile")).load(where).select("length")
    if not listed.where(F.col("length") > split_above).isEmpty():
        lines = scan(spark.read.option("lineSep", "\n")).text(where).where(size > split_above)
        split = read_split_csv(lines, columns, _file_path())
        rows = rows.unionAll(split.select("path", "row", *columns))
    if not with_source:
        return rows.select(*columns).fillna("")
    return (
        rows.withColumn(ORDER, F.struct(
            path_parts(F.col("__path")).alias("path"), F.col("__row").alias("row")))
        .withColumn("source_dataset", source_dataset_name(F.col("__path"), path))
        .withColumn("source_file", file_name(F.col("__path")))
        .select("source_dataset", "source_file", *columns, ORDER)
        .fillna("")
    )


def read_bronze_batches(
    spark: SparkSession, folder: str, pattern: str, columns: list[str],
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """All batch files below a folder. Headers may differ from file to file: columns are matched by
    name, a missing one reads as '', an extra one is an error."""
    layouts = _layouts(spark, folder, pattern) if exists(spark, folder) else []
    if not layouts:
        raise NoInputError(f"No CSV files matched {pattern} in {folder}")
    extra = {c for names, _ in layouts for c in names} - set(columns)
    if extra:
        raise ValueError(f"Unexpected columns below {folder}: {', '.join(sorted(extra))}")
    parts = [
        project_fields(
            read_csv_strings(spark, folder, list(names), pattern, with_source=True, paths=paths,
                             split_above=split_above),
            [*schemas.LINEAGE, *columns, ORDER])
        for names, paths in layouts
    ]
    return reduce(DataFrame.unionByName, parts)


def _layouts(
    spark: SparkSession, folder: str, pattern: str
) -> list[tuple[tuple[str, ...], list[str] | None]]:
    """Each header among the files with the paths that have it; None stands for the whole folder.

    The first line of a file is kept in the scan, line by line, so no file is held as a whole. The
    driver sees one row per query folder and header, and file names only of folders whose files
    differ."""
    path = _file_path()
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern) \
        .text(folder).where(F.col("_metadata.file_block_start") == 0) \
        .select(path.alias("path"), "value", F.monotonically_increasing_id().alias("line"))
    first = lines.groupBy("path").agg(F.min_by("value", "line").alias("header"))
    folders = first.groupBy(source_dataset_name(F.col("path"), folder).alias("dataset"), "header") \
        .agg(F.count("*").alias("n"), F.min("path").alias("example"))
    found = folders.orderBy("dataset", "header").collect()
    if not found:
        return []
    names = {r.header: next(csv.reader([r.header.lstrip("\ufeff").rstrip("\r")]), [])
             for r in found}
    if len({tuple(v) for v in names.values()}) == 1:
        return [(tuple(next(iter(names.values()))), None)]
    headers: dict[str, set[str]] = {}
    for r in found:
        headers.setdefault(r.dataset, set()).add(r.header)
    mixed = [d for d, own in headers.items() if len(own) > 1]
    base, paths = folder.rstrip("/"), {}
    for r in found:
        if r.dataset not in mixed:
            paths.setdefault(tuple(names[r.header]), []).append(
                f"{base}/{pattern}" if r.dataset == "root" else f"{base}/{r.dataset}")
    if mixed:
        for r in first.where(source_dataset_name(F.col("path"), folder).isin(mixed)).collect():
            paths.setdefault(tuple(names[r.header]), []).append(r.path)
    return list(paths.items())


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header that `read_csv_strings` (or any RFC 4180 reader) reads back unchanged."""
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("emptyValue", "").option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_snapshot(df: DataFrame, path: str) -> str:
    """Write a table beside its earlier snapshots; nothing stored is touched or renamed."""
    stamp = datetime.now(UTC).strftime("%Y%m%dT%H%M%S%fZ")
    fresh = f"{path.removesuffix('.csv')}-{stamp}.csv"
    write_csv(df, fresh)
    return fresh


def newest_snapshot(spark: SparkSession, path: str) -> str | None:
    """The newest complete snapshot of a table, else the table at `path` itself, else None."""
    written = [s.getPath().toString() for s in
               matching_files(spark, f"{path.removesuffix('.csv')}-[0-9]*T[0-9]*Z.csv")]
    # a write that broke off leaves no success mark
    whole = [p for p in sorted(written) if exists(spark, f"{p}/_SUCCESS")]
    if whole:
        return whole[-1]
    return path if exists(spark, path) else None


def blanks_to_null(df: DataFrame) -> DataFrame:
    """The silver Parquet boundary: '' before it, NULL after it."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    return df.select(*[blank_to_null(F.col(c)).alias(c) if c in text else c for c in df.columns])


def project_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Fixed projection; a column the table lacks reads as ''."""
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in fields])


def write_parquet(df: DataFrame, path: str) -> int:
    """Overwrite a Parquet table and return its row count (read from the file footers)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def read_tables(spark: SparkSession, folder: str, names: list[str], what: str) -> dict[str, DataFrame]:
    paths = {name: f"{folder.rstrip('/')}/{name}.parquet" for name in names}
    require(spark, paths, what)
    return {name: spark.read.parquet(path) for name, path in paths.items()}
