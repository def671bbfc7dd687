"""First-wins and last-wins deduplication.

Tables that need an order carry it in the struct column `row_order`, which compares rows the way
the landed files are read: path by path, then row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqlake.operators.lineage import (
    named_sources, number_sources, source, source_words, with_names,
)
from seqlake.operators.skew import HOT_KEY_ROWS, MAX_BROADCAST_ROWS, is_small, lookup_join
from seqlake.schemas import LINEAGE
from seqlake.session import materialize

ORDER = "row_order"


def keep_first(df: DataFrame, keys: list[str | Column], *order: Column) -> DataFrame:
    """One row per key. Spark prunes to one row per key and task before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*(order or [F.col(ORDER)]))
    return (
        df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")
    )


def keep_last(df: DataFrame, keys: list[str | Column], order: str = ORDER) -> DataFrame:
    return keep_first(df, keys, F.col(order).desc())


def keep_first_of_few(df: DataFrame, keys: list[str]) -> DataFrame:
    """`keep_first` for a stored table in which keys repeat rarely. Only hashes of the keys are
    shuffled to find out which repeat; rows of the others stay where they are. Where more keys repeat
    than a broadcast may hold, all rows go through `keep_first`."""
    marked = df.withColumn("__hash", F.xxhash64(*keys))
    repeated = materialize(
        marked.groupBy("__hash").agg(F.count("*").alias("n")).where("n > 1").select("__hash"),
        "repeated-keys")
    if repeated.count() > MAX_BROADCAST_ROWS:
        return keep_first(df, keys)
    once = marked.join(F.broadcast(repeated), "__hash", "left_anti").drop("__hash")
    several = marked.join(F.broadcast(repeated), "__hash", "left_semi").drop("__hash")
    return once.unionByName(keep_first(several, keys))


#: Keys are counted by so many buckets of their hash, to find those that repeat too often for one task.
COUNT_BUCKETS = 1 << 16


def merge_duplicates(df: DataFrame, keys: list[str], source_order: list[Column]) -> DataFrame:
    """First row per key, carrying every source the key was seen in, by first appearance.

    Rows are dealt out by the key once, with the number of their source, and neither sorted nor spilled
    before that. Keys in a bucket of more than HOT_KEY_ROWS rows take the way of `_merge_apart`, which
    reduces them per task before any shuffle; so do all rows where the sources are too many to be
    broadcast. Both ways give the same rows. A missing key part reads as ''.
    """
    filled = df.fillna("", keys)
    sources = number_sources(filled, source_order)
    if not is_small(sources):
        return _merge_apart(filled, keys, source_order, sources)
    marked = filled.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(COUNT_BUCKETS)).cast("int"))
    hot = materialize(
        marked.groupBy("__bucket").agg(F.count("*").alias("n")).where(F.col("n") > HOT_KEY_ROWS)
        .select("__bucket"), "hot-buckets")
    if hot.isEmpty():
        return _merge_dealt(filled, keys, source_order, sources)
    once, often = (marked.join(F.broadcast(hot), "__bucket", how).drop("__bucket")
                   for how in ("left_anti", "left_semi"))
    return _merge_dealt(once, keys, source_order, sources).unionByName(
        _merge_apart(often, keys, source_order, sources))


def _payload(df: DataFrame, keys: list[str]) -> list[str]:
    # With the order as leading field, the smallest struct is the first row.
    return [ORDER, *[c for c in df.columns if c not in (*keys, *LINEAGE, ORDER)]]


#: Between packed values, before a letter that stands for a control character or a missing value.
BETWEEN, MARK = "\u0002", "\u0001"


def pack(columns: list[str]) -> Column:
    """Text columns as one text, a third of the columns' size in a shuffle. It orders like the struct of
    the columns where they have no control characters; `unpack` gives back all values unchanged."""
    marked = [F.replace(F.replace(c, F.lit(MARK), F.lit(f"{MARK}a")), F.lit(BETWEEN), F.lit(f"{MARK}b"))
              for c in map(F.col, columns)]
    # the end is marked too: a missing last value is then less than an empty one
    return F.concat_ws(BETWEEN, *[F.coalesce(c, F.lit(f"{MARK}n")) for c in marked], F.lit(""))


def unpack(parts: Column, place: int) -> Column:
    """The value at `place` of a packed text that was split at BETWEEN."""
    part = F.get(parts, F.lit(place))
    return F.when(part != f"{MARK}n", F.replace(F.replace(
        part, F.lit(f"{MARK}b"), F.lit(BETWEEN)), F.lit(f"{MARK}a"), F.lit(MARK)))


def _merge_dealt(
    filled: DataFrame, keys: list[str], source_order: list[Column], sources: DataFrame
) -> DataFrame:
    """Rows and their sources meet at the key in one shuffle."""
    order, *rest = _payload(filled, keys)
    types = dict(filled.dtypes)
    texts = [c for c in rest if types[c] == "string"]
    others = [c for c in rest if types[c] != "string"]
    packed = [pack(texts).alias("__texts")] * bool(texts)
    rows = filled.select(*keys, order, *others, *packed, source(source_order).alias("source"))
    coded = lookup_join(rows, sources, "source", keys).drop("source")
    whole = F.struct(order, *others, *["__texts"] * bool(texts))
    per_word = coded.repartition(*keys).groupBy(*keys, "word").agg(
        F.min(whole).alias("__first"), F.bit_or("bit").alias("bits"))

    def listed(words: DataFrame) -> DataFrame:
        return with_names(words, keys, sources, ["__first"])

    if not sources.where("word > 0").isEmpty():
        # keys whose sources are in one word are complete, the others are joined from their words
        words = materialize(per_word.withColumn(
            "__words", F.count("*").over(Window.partitionBy(*keys))), "merged-words")
        several = words.where("__words > 1")
        first = several.groupBy(*keys).agg(F.min("__first").alias("__first"))
        merged = listed(words.where("__words = 1")).unionByName(first.join(
            named_sources(several.select(*keys, "word", "bits"), keys, sources), keys))
    else:
        merged = listed(per_word)
    if texts:
        merged = merged.withColumn("__texts", F.split(F.col("__first")["__texts"], BETWEEN))
    value = lambda c: unpack(F.col("__texts"), texts.index(c)) if c in texts else F.col("__first")[c]
    return merged.select(*LINEAGE, *keys, *[value(c).alias(c) for c in (order, *rest)])


def _merge_apart(
    filled: DataFrame, keys: list[str], source_order: list[Column], sources: DataFrame
) -> DataFrame:
    """First rows and sources are aggregated apart, each reduced per task before its shuffle: a key that
    repeats across the whole table moves one wide row and a few bitmap words per task. Both sides are
    then dealt out by the key, so they join without a further shuffle."""
    payload = _payload(filled, keys)
    first = filled.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("__first"))
    lists = named_sources(source_words(filled, keys, source_order, sources), keys, sources)
    return first.join(lists, keys).select(
        *LINEAGE, *keys, *[F.col("__first")[c].alias(c) for c in payload])


def upsert(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Union by key in which incoming rows replace existing ones."""
    ranked = incoming.withColumn("__age", F.lit(0)).unionByName(
        existing.withColumn("__age", F.lit(1))
    )
    return keep_first(ranked, [key], F.col("__age")).drop("__age")
