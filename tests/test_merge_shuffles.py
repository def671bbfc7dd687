"""The merge deals out its wide rows once, and silver leaves rows of unrepeated keys where they are."""

import random

import pytest
from pyspark.sql import functions as F

from seqlake.operators import dedupe

def order():
    return [F.col("row_order.source_dataset"), F.col("row_order.source_file")]


def landed(spark, files, seed):
    draw = random.Random(seed)
    rows = [(draw.choice(["a", "b", None]), draw.choice(files), i % 40, draw.choice("xyz") * 3,
             None if i % 11 == 0 else f"k{draw.randrange(60)}", draw.choice(["k", ""])) for i in range(600)]
    df = spark.createDataFrame(
        rows, "source_dataset string, source_file string, at int, v string, k string, l string")
    return df.withColumn("row_order", F.struct("source_dataset", "source_file", "at")).drop("at")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df, column):
    return plan(df).count(f"Exchange hashpartitioning({column}")


def everything(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_the_merge_deals_out_wide_rows_once(spark):
    merged = dedupe.merge_duplicates(landed(spark, ["f1", "f2"], 1), ["k", "l"], order())
    assert shuffles(merged, "k") == 1


@pytest.mark.parametrize("files", [["f1", "f2"], [f"f{i:03d}" for i in range(150)]])
@pytest.mark.parametrize("hot", [10, 10**6])
def test_both_ways_give_the_same_rows(spark, monkeypatch, files, hot):
    df = landed(spark, files, 2).repartition(5)
    apart = dedupe._merge_apart(
        df.fillna("", ["k", "l"]), ["k", "l"], order(), dedupe.number_sources(df, order()))
    monkeypatch.setattr(dedupe, "HOT_KEY_ROWS", hot)
    monkeypatch.setattr(dedupe, "COUNT_BUCKETS", 64)
    merged = dedupe.merge_duplicates(df, ["k", "l"], order())
    assert merged.columns == apart.columns and everything(merged) == everything(apart)


@pytest.mark.parametrize("limit", [0, 200_000])
def test_few_repeated_keys(spark, monkeypatch, limit):
    df = landed(spark, ["f1", "f2"], 3)
    df = df.unionByName(df.withColumn("k", F.concat(F.lit("one"), F.monotonically_increasing_id())))
    monkeypatch.setattr(dedupe, "MAX_BROADCAST_ROWS", limit)
    # rows of equal order are told apart by nothing: compare what they are ordered by
    pick = lambda rows: everything(rows.select("k", "row_order"))
    assert pick(dedupe.keep_first_of_few(df, ["k"])) == pick(dedupe.keep_first(df, ["k"]))


def test_rows_of_unrepeated_keys_are_not_dealt_out(spark):
    df = spark.range(50).selectExpr("concat('k', id % 40) AS k", "struct(id) AS row_order", "'w' AS wide")
    kept = dedupe.keep_first_of_few(df, ["k"])
    assert kept.count() == 40
    # only the branch of the repeated keys, the later one, has an exchange above its join
    assert plan(kept).index("LeftAnti") < plan(kept).index("Exchange hashpartitioning(k") \
        < plan(kept).index("LeftSemi")


def test_packed_values_come_back_unchanged(spark):
    values = [None, "", "n", "a", "b", "\u0001", "\u0001n", "\u0001a", "\u0001b", "\u0002", "\u0002\u0001ab", " x,\n\"y\" "]
    rows = [(a, b, c) for a in values for b in values for c in values[:4]]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    parts = F.split(dedupe.pack(["a", "b", "c"]), dedupe.BETWEEN)
    back = df.withColumn("parts", parts).select(
        "a", "b", "c", *[dedupe.unpack(F.col("parts"), i).alias(f"x{i}") for i in range(3)])
    assert all(tuple(r[:3]) == tuple(r[3:]) for r in back.collect())


def test_equal_orders_are_settled_as_before(spark):
    draw = random.Random(4)
    rows = [("d", "f", 0, draw.choice([None, "", "a", "ab", "b"]), draw.choice([None, "", "x"]), f"k{i % 7}", "")
            for i in range(60)]
    df = spark.createDataFrame(
        rows, "source_dataset string, source_file string, at int, v string, w string, k string, l string") \
        .withColumn("row_order", F.struct("source_dataset", "source_file", "at")).drop("at")
    apart = dedupe._merge_apart(df, ["k", "l"], order(), dedupe.number_sources(df, order()))
    assert everything(dedupe.merge_duplicates(df, ["k", "l"], order())) == everything(apart)
