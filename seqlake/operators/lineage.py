"""Which sources each key was seen in, as bitmaps over numbered sources.

Sources are numbered in reading order. A key's sources are bits of 64-bit words, one row per key and
word, so partial results merge with a bitwise or before and after the shuffle, and a key that is
in a million sources takes 16,000 rows of two numbers, in any number of tasks. (Spark's
bitmap_construct_agg has buffers of a fixed 4 KB per key, too much where most keys have one
source.) Words meet the names of their 64 sources by an equi join; only a key's final list is as
long as its sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlake.operators.batches import with_row_index
from seqlake.operators.skew import lookup_join
from seqlake.schemas import LINEAGE
from seqlake.session import materialize
from seqlake.vocab import LIST_SEPARATOR

WORD = 64


def source(source_order: list[Column]) -> Column:
    return F.struct(F.struct(*source_order).alias("at"), *LINEAGE)


def number_sources(df: DataFrame, source_order: list[Column]) -> DataFrame:
    """source (struct of order, dataset, file), word and bit of every distinct source."""
    numbered = with_row_index(df.select(source(source_order).alias("source")).distinct(), ["source"])
    return materialize(numbered.select(
        "source", F.expr(f"row_index div {WORD}").alias("word"),
        F.expr(f"shiftleft(1L, cast(row_index % {WORD} as int))").alias("bit")), "sources")


def source_words(
    df: DataFrame, keys: list[str], source_order: list[Column], sources: DataFrame
) -> DataFrame:
    """keys, word, bits: the sources of every key as set bits. Words of several tables that share
    their numbered sources add up with `merge_words`."""
    coded = lookup_join(
        df.select(*keys, source(source_order).alias("source")), sources, "source", keys)
    return coded.groupBy(*keys, "word").agg(F.bit_or("bit").alias("bits"))


def merge_words(words: DataFrame, keys: list[str]) -> DataFrame:
    return words.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))


def _word_names(
    words: DataFrame, keys: list[str], sources: DataFrame, keep: list[str] = ()
) -> tuple[DataFrame, list[Column]]:
    """`words` with the sources that are present in each, and per lineage column their distinct names."""
    names = sources.groupBy("word").agg(F.array_sort(F.collect_list(
        F.struct("source", "bit"))).alias("names"))  # up to 64 sources
    present = F.filter("names", lambda s: s["bit"].bitwiseAND(F.col("bits")) != 0)
    parts = lookup_join(words, names, "word", keys).select(
        *keys, *keep, "word", F.transform(present, lambda s: s["source"]).alias("present"))
    return parts, [
        F.array_distinct(F.transform("present", lambda s: s[c])).alias(c) for c in LINEAGE]


def with_names(
    words: DataFrame, keys: list[str], sources: DataFrame, keep: list[str]
) -> DataFrame:
    """As `named_sources`, for keys of one word each; `keep` are further columns."""
    parts, names = _word_names(words, keys, sources, keep)
    return parts.select(*keys, *keep, *names).select(
        *keys, *keep, *[F.array_join(c, LIST_SEPARATOR).alias(c) for c in LINEAGE])


def named_sources(words: DataFrame, keys: list[str], sources: DataFrame) -> DataFrame:
    """keys, and per lineage column the distinct names by first appearance, as one text."""
    parts, names = _word_names(words, keys, sources)
    listed = parts.select(*keys, F.struct("word", *names).alias("part")).groupBy(*keys).agg(
        F.array_sort(F.collect_list("part")).alias("parts"))
    return listed.select(*keys, *[
        F.array_join(F.array_distinct(F.flatten(F.col(f"parts.{c}"))), LIST_SEPARATOR).alias(c)
        for c in LINEAGE])
