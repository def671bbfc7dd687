"""Large CSV files with quoted line breaks, read by many tasks.

Spark splits a text file at line breaks but not a multi-line CSV file, because whether a line break
ends a record depends on all quotes before it. So the file is read as lines, and each line says what
it does to the state "inside quotes": keep it, flip it, or set it. Such maps compose, so what a chunk of
lines does follows from the last line that sets the state and the flips after it, and a composition
over the few chunks of a file gives the state at the start of each. Then the lines are shuffled once, by
chunk: there a prefix composition gives the state at every line, and the lines of a record are joined.
Only pieces of records that run over the border of a chunk, two a chunk at most, meet once more. Records
are then parsed by Spark's own CSV parser.

A quote opens a field only at the field's start and is doubled inside it; other quotes are text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqlake import schemas
from seqlake.operators.skew import lookup_join
from seqlake.session import materialize, materialize_parts, stored

#: Lines of a chunk as a power of two, lines that a task puts in order at once, and that are shuffled at once.
CHUNK_BITS = 16
LINES_PER_TASK = 500_000
LINES_PER_ROUND = 20_000_000

# Possessive, so that no backtracking runs over long fields.
_REST_OF_FIELD = r'[^"]*+(?:""[^"]*+)*+"'
_CLOSED_FIELD = rf'(?:^|(?<=,)){chr(34)}{_REST_OF_FIELD}'
_OPENED = r'(?:^|,)"'


def _opens(text: Column) -> Column:
    """Whether a quote is open at the end of a text that starts outside quotes."""
    return F.regexp_replace(text, _CLOSED_FIELD, "x").rlike(_OPENED)


def line_effect(line: Column) -> tuple[Column, Column]:
    """Whether a line ends inside quotes if it starts outside them, and if it starts inside."""
    quoted = F.contains(line, F.lit('"'))
    closes = line.rlike("^" + _REST_OF_FIELD)
    rest = F.regexp_replace(line, "^" + _REST_OF_FIELD, "x")
    return (F.when(quoted, _opens(line)).otherwise(False),
            F.when(quoted & closes, _opens(rest)).otherwise(True))


def _composed(frame: DataFrame, window, before: str) -> DataFrame:
    """Adds `<before>_out` and `<before>_in`: the state before each row of the ordered window if the
    window starts outside or inside quotes, from the rows' `ends_out` and `ends_in`."""
    constant, flips = F.col("ends_out") == F.col("ends_in"), F.col("ends_out") & ~F.col("ends_in")
    preceding = window.rowsBetween(Window.unboundedPreceding, -1)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = frame.withColumn("__flips", F.sum(flips.cast("bigint")).over(upto))
    # the last line that sets the state, and the flips since then
    fixed = F.last(F.when(constant, F.struct(F.col("ends_out").alias("state"), "__flips")),
                   ignorenulls=True).over(preceding)
    placed = counted.withColumn("__set", fixed).withColumn(
        "__before", F.coalesce(F.lag("__flips").over(window), F.lit(0)))
    odd = (F.col("__before") - F.coalesce(F.col("__set.__flips"), F.lit(0))) % 2 == 1
    state = lambda start: F.coalesce(F.col("__set.state"), F.lit(start)) != odd
    return placed.withColumns({f"{before}_out": state(False), f"{before}_in": state(True)}) \
        .drop("__flips", "__set", "__before")


def _chunks(lines: DataFrame) -> DataFrame:
    """key, first and last (lines), lines (how many), path, inside (the state it starts in), number (in the
    file), returns (whether the file's lines end in \\r\\n, as its first line says) of the lines of each key."""
    sets = F.col("ends_out") == F.col("ends_in")
    # a line and what it says in one number, as Spark sorts all rows to aggregate structs
    marked = lambda flag: F.shiftleft("line", 1).bitwiseOR(F.col(flag).cast("bigint"))
    last = lines.groupBy("key").agg(
        F.max(F.when(sets, marked("ends_out"))).alias("set"), F.min(marked("returns")).alias("head"),
        F.max("line").alias("last"), F.count("*").alias("lines"))
    flips = lookup_join(
        lines.where(F.col("ends_out") & ~F.col("ends_in")).select("key", "line"),
        last.select("key", F.shiftright("set", 1).alias("set_line")), "key", ["line"]
    ).where("set_line IS NULL OR line > set_line").groupBy("key").agg(F.count("*").alias("flips"))
    odd = F.coalesce(F.col("flips"), F.lit(0)) % 2 == 1
    effect = lambda start: F.coalesce(F.col("set") % 2 == 1, F.lit(start)) != odd
    ends = last.join(flips, "key", "left").select(
        "key", "key.path", "last", "lines", F.shiftright("head", 1).alias("first"), (F.col("head") % 2 == 1).alias("returns"),
        effect(False).alias("ends_out"), effect(True).alias("ends_in"))
    in_file = Window.partitionBy("path").orderBy("key.block", "first")
    return _composed(ends, in_file, "inside").select(
        "key", "first", "last", "lines", "path", F.col("inside_out").alias("inside"),  # a file starts outside quotes
        (F.row_number().over(in_file) - 1).cast("bigint").alias("number"),
        F.first("returns").over(in_file).alias("returns"))


def _rounds(chunks: DataFrame) -> list[tuple[int, int, int]]:
    """The lines in ranges of whole chunks, LINES_PER_ROUND each at most: first, beyond the last, how many."""
    rounds: list[list[int]] = []
    for c in chunks.select("first", "last", "lines").orderBy("first").collect():
        if not rounds or rounds[-1][2] + c.lines > LINES_PER_ROUND:
            rounds.append([c["first"], 0, 0])
        rounds[-1][1:] = c["last"] + 1, rounds[-1][2] + c.lines
    return [tuple(r) for r in rounds] or [(0, 0, 0)]


def _pieces(lines: DataFrame, chunks: DataFrame, total: int) -> DataFrame:
    """path, row, record, and whether it `starts` and `ends` in its chunk: the records of each chunk."""
    bit = lambda name, at: F.shiftleft(F.col(name).cast("bigint"), at)
    state = bit("inside", 2).bitwiseOR(bit("ends_out", 1)).bitwiseOR(bit("ends_in", 0))
    cores = lines.sparkSession.sparkContext.defaultParallelism
    dealt = lookup_join(
        lines.select("key", "line", "value", "ends_out", "ends_in"),
        chunks.select("key", "first", "inside", "returns"), "key", ["line"]
    ).select(  # narrow rows, as all of them are shuffled
        "first", F.shiftleft(F.col("line") - F.col("first"), 3).bitwiseOR(state).alias("packed"),
        F.when(F.col("returns"), F.regexp_replace("value", r"\r$", "")).otherwise(F.col("value")).alias("value"),
    ).repartition(max(cores, total // LINES_PER_TASK), "first")
    flag = lambda at: F.col("packed").bitwiseAND(1 << at) != 0
    in_chunk = Window.partitionBy("first").orderBy("at")
    upto = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = _composed(dealt.select(
        "first", F.shiftright("packed", 3).alias("at"), "value", flag(2).alias("inside"),
        flag(1).alias("ends_out"), flag(0).alias("ends_in")), in_chunk, "starts")
    starts = F.when(F.col("inside"), F.col("starts_in")).otherwise(F.col("starts_out"))
    after = F.when(F.col("starts"), F.col("ends_in")).otherwise(F.col("ends_out"))
    placed = rows.withColumn("starts", starts).withColumn("after", after).withColumn(
        "start", F.last(F.when(~F.col("starts"), F.col("at")), ignorenulls=True).over(upto))
    found = placed.groupBy("first", "start").agg(
        F.array_sort(F.collect_list(F.struct("at", "value", "after"))).alias("parts")).select(
            "first", F.col("parts")[0]["at"].alias("at"),
            F.array_join(F.col("parts.value"), "\n").alias("record"),
            F.col("start").isNotNull().alias("starts"),
            (~F.element_at("parts", -1)["after"]).alias("ends"))
    return lookup_join(found, chunks.select("first", "path", "number"), "first", ["at"]).select(
        "path", F.expr("shiftleft(number, 33)").bitwiseOR(F.col("at")).alias("row"), "record", "starts", "ends")


def split_records(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """path, row (order in the file), record (text, its line breaks as \\n) from lines (path, block,
    line, value) cut at \\n, where `line` is unique, ascends within a block and is of one block at a time."""
    ends_out, ends_in = line_effect(F.col("value"))
    key = F.struct("path", "block", F.shiftright("line", CHUNK_BITS).alias("chunk"))
    scanned = lines.select(
        key.alias("key"), "line", "value", ends_out.alias("ends_out"), ends_in.alias("ends_in"),
        F.endswith("value", F.lit("\r")).alias("returns")).coalesce(spark.sparkContext.defaultParallelism)
    with stored(scanned, "csv-lines", compression="zstd") as known:
        chunks = materialize(_chunks(known), "csv-chunks")
        pieces = materialize_parts(
            [_pieces(known.where((F.col("line") >= first) & (F.col("line") < beyond)), chunks, total)
             for first, beyond, total in _rounds(chunks)], "csv-records", compression="zstd")
    whole = F.col("starts") & F.col("ends")
    in_file = Window.partitionBy("path").orderBy("row")
    several = pieces.where(~whole).withColumn(
        "start", F.last(F.when(F.col("starts"), F.col("row")), ignorenulls=True).over(in_file)
    ).groupBy("path", "start").agg(
        F.array_sort(F.collect_list(F.struct("row", "record"))).alias("parts")).select(
            "path", F.col("parts")[0]["row"].alias("row"),
            F.array_join(F.col("parts.record"), "\n").alias("record"))
    return pieces.where(whole).select("path", "row", "record").unionAll(several)


def read_split_csv(rows: DataFrame, columns: list[str], path: Column) -> DataFrame:
    """path, row and `columns` of every record of the scanned text `rows`; a file's header must be
    `columns`."""
    lines = rows.select(
        path.alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")
    records = split_records(rows.sparkSession, lines)
    names = [f"c{i}" for i in range(len(columns))]
    parsed = F.from_csv(F.col("record"), ", ".join(f"{n} string" for n in names),
                        {"escape": '"', "multiLine": "true"})
    header = F.col("row") == 0
    found = F.lower(F.concat_ws(",", *[F.col(f"__r.{n}") for n in names]))
    wanted = ",".join(columns).lower()
    checked = F.when(header & (F.regexp_replace(found, "^﻿", "") != wanted), F.raise_error(
        F.concat(F.lit("CSV header does not conform to the schema: "), F.col("path")))) \
        .otherwise(header)
    return records.where("record <> ''").select("path", "row", parsed.alias("__r")) \
        .where(~checked).select(
            "path", "row", *[F.col(f"__r.{n}").alias(c) for n, c in zip(names, columns)])
