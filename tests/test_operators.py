import random

import pytest
from pyspark.sql import functions as F

from seqlake.operators import batches, dedupe, distinct, lineage, skew


def ordered(spark, data):
    """(dataset, file, position, key, value) rows with row_order as bronze has it."""
    df = spark.createDataFrame(data, "source_dataset string, source_file string, at int, k string, v string")
    return df.withColumn("row_order", F.struct("source_dataset", "source_file", "at")).drop("at")


def merge_in_python(data):
    first, datasets, files = {}, {}, {}
    for dataset, file, _, key, value in sorted(data, key=lambda r: r[:3]):
        first.setdefault(key, value)
        datasets.setdefault(key, dict())[dataset] = None
        files.setdefault(key, dict())[file] = None
    return {k: (v, " | ".join(datasets[k]), " | ".join(files[k])) for k, v in first.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_duplicates_matches_a_sequential_merge(spark, seed):
    draw = random.Random(seed)
    data = [(draw.choice("xyz"), f"f{draw.randrange(4)}.csv", i,
             "hot" if i % 3 == 0 else f"k{draw.randrange(40)}", f"v{i}") for i in range(500)]
    draw.shuffle(data)
    order = [F.col("row_order.source_dataset"), F.col("row_order.source_file")]
    merged = dedupe.merge_duplicates(ordered(spark, data).repartition(7), ["k"], order)
    found = {r.k: (r.v, r.source_dataset, r.source_file) for r in merged.collect()}
    assert found == merge_in_python(data)


def test_merge_keeps_the_order_of_the_first_row(spark):
    data = [("a", "1", 1, "k", "first"), ("a", "1", 2, "j", "x"), ("b", "2", 1, "k", "second")]
    order = [F.col("row_order.source_dataset")]
    merged = dedupe.merge_duplicates(ordered(spark, data), ["k"], order)
    row = merged.where("k = 'k'").first()
    assert (row.v, row.row_order.source_dataset, row.row_order["at"]) == ("first", "a", 1)


def test_keep_first_prunes_before_the_shuffle(spark):
    data = [("a", "1", i, "hot" if i % 3 == 0 else f"k{i}", f"v{i}") for i in range(300)]
    kept = dedupe.keep_first(ordered(spark, data), ["k"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    found = {r.k: r.v for r in kept.collect()}
    assert found["hot"] == "v0" and len(found) == 201


def test_keep_last_and_upsert(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "id string, row_order int, v string")
    assert {r.id: r.v for r in dedupe.keep_last(df, ["id"]).collect()} == {"a": "y", "b": "z"}
    old = spark.createDataFrame([("a", "old"), ("b", "old")], "id string, v string")
    new = spark.createDataFrame([("b", "new"), ("c", "new")], "id string, v string")
    merged = {r.id: r.v for r in dedupe.upsert(old, new, "id").collect()}
    assert merged == {"a": "old", "b": "new", "c": "new"}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_a_plain_join(spark, how):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"), "id")
    dim = spark.range(90).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("d")).union(
        spark.sql("SELECT 'hot', 1000"))
    salted = skew.salted_join(fact, dim, "k", ["id"], how, hot_rows=100)
    plain = fact.join(dim, "k", how)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, salted.select("k", "id", "d").collect())) == sorted(
        map(key, plain.select("k", "id", "d").collect()))


def test_lookup_broadcasts_only_small_tables(spark, monkeypatch):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        fact = spark.range(50).select(F.col("id").cast("string").alias("k"))
        dim = spark.range(10).select(F.col("id").cast("string").alias("k"), F.lit("x" * 50).alias("v"))
        joins = lambda **limits: skew.lookup_join(
            fact, dim, "k", ["k"], **limits)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in joins()
        assert "SortMergeJoin" in joins(max_rows=9)
        monkeypatch.setattr(skew, "MAX_BROADCAST_CHARS", 100)
        assert "SortMergeJoin" in joins()
    finally:
        spark.conf.set(conf, before)


def test_salted_join_spreads_the_hot_key(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact = spark.range(4000).select(F.lit("hot").alias("k"), "id")
        dim = spark.sql("SELECT 'hot' AS k, 1 AS d")
        joined = skew.salted_join(fact, dim, "k", ["id"], hot_rows=100)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2500
        assert joined.count() == 4000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_without_a_key_match_nothing(spark):
    left = spark.createDataFrame([("S1", "B1"), ("", "B2"), (None, "S1")], "s string, b string")
    keyed = left.withColumn("k", skew.key_or_spread("s", "b"))
    right = spark.createDataFrame([("S1", 5), ("B2", 6)], "k string, n int")
    found = {(r.s, r.b): r.n for r in keyed.join(right, "k", "left").collect()}
    assert found == {("S1", "B1"): 5, ("", "B2"): None, (None, "S1"): None}


def test_row_index_is_global(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("v"))
    found = batches.with_row_index(df, ["v"]).collect()
    assert sorted((r.row_index, r.v) for r in found) == [(i, i) for i in range(1000)]


def test_batch_ids(spark):
    df = spark.createDataFrame([(str(i),) for i in range(11)], "id string")
    found = batches.batch_ids(df, "id", 4, [F.col("id").cast("int")])
    assert {r.batch_number: r.ids for r in found.collect()} == {
        1: ["0", "1", "2", "3"], 2: ["4", "5", "6", "7"], 3: ["8", "9", "10"]}
    with pytest.raises(ValueError):
        batches.batch_ids(df, "id", 0, ["id"])


def test_batch_windows(spark, monkeypatch):
    monkeypatch.setattr(batches, "WINDOWS_PER_BLOCK", 3)
    totals = spark.createDataFrame([("a", 450), ("none", 0), ("many", 2001)], "job string, total bigint")
    found = batches.batch_windows(totals, "total", 200).collect()
    for job, total in (("a", 450), ("none", 0), ("many", 2001)):
        windows = sorted((r.batch_number, r.retstart, r.retmax) for r in found if r.job == job)
        expected = [(i + 1, s, min(200, total - s)) for i, s in enumerate(range(0, total, 200))]
        assert windows == expected
    with pytest.raises(ValueError):
        batches.batch_windows(totals, "total", 0)
    with pytest.raises(Exception, match="non-negative"):
        batches.batch_windows(spark.sql("SELECT -1L AS total"), "total", 5).collect()


def test_pending_batches(spark):
    windows = batches.batch_windows(spark.sql("SELECT 'j' AS job_id, 500L AS total"), "total", 200)
    done = spark.sql("SELECT * FROM VALUES ('j', 200L), ('other', 0L), ('j', 200L) AS t(job_id, retstart)")
    left = batches.pending_batches(windows, done, ["job_id", "retstart"])
    assert sorted(r.retstart for r in left.collect()) == [0, 400]


# --- lineage bitmaps and distinct states -----------------------------------------------------

def test_a_key_in_very_many_sources(spark):
    """70,000 sources of one key are some thousand words, and come out in reading order."""
    n = 70_000
    df = spark.range(n).selectExpr(
        "concat('d', lpad(id div 1000, 3, '0')) AS source_dataset",
        "concat('f', lpad(id, 6, '0'), '.csv') AS source_file",
        "if(id % 2 = 0, 'hot', concat('k', id)) AS k", "id AS v").repartition(8)
    df = df.withColumn("row_order", F.struct("source_dataset", "source_file"))
    order = [F.col("row_order.source_dataset"), F.col("row_order.source_file")]
    sources = lineage.number_sources(df, order)
    words = lineage.source_words(df, ["k"], order, sources)
    hot = words.where("k = 'hot'").agg(
        F.count("*").alias("words"), F.sum(F.bit_count("bits").cast("bigint")).alias("bits")).first()
    assert hot.words == -(-n // 64) and hot.bits == n // 2
    merged = dedupe.merge_duplicates(df, ["k"], order).where("k = 'hot'").first()
    assert merged.source_file == " | ".join(f"f{i:06d}.csv" for i in range(0, n, 2))
    assert merged.source_dataset == " | ".join(f"d{i:03d}" for i in range(70))


def test_words_of_parts_add_up(spark):
    df = ordered(spark, [("a", f"f{i % 5}.csv", i, f"k{i % 3}", "v") for i in range(60)])
    order = [F.col("row_order.source_dataset"), F.col("row_order.source_file")]
    sources = lineage.number_sources(df, order)
    parts = [lineage.source_words(df.where(f"v = 'v' AND row_order.at % 2 = {r}"), ["k"], order, sources)
             for r in (0, 1)]
    added = lineage.merge_words(parts[0].unionByName(parts[1]), ["k"])
    whole = lineage.source_words(df, ["k"], order, sources)
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, whole.collect()))


def test_missing_key_parts_merge_as_blank(spark):
    df = spark.createDataFrame(
        [("a", "1", 1, None, "x"), ("a", "2", 1, "", "y"), ("b", "1", 1, "k", "z")],
        "source_dataset string, source_file string, at int, k string, v string") \
        .withColumn("row_order", F.struct("source_dataset", "source_file", "at")).drop("at")
    order = [F.col("row_order.source_dataset"), F.col("row_order.source_file")]
    found = {r.k: (r.v, r.source_file) for r in dedupe.merge_duplicates(df, ["k"], order).collect()}
    assert found == {"": ("x", "1 | 2"), "k": ("z", "1")}


def test_distinct_states_add_up_over_snapshots(spark):
    draw = random.Random(7)
    rows = [(draw.choice("ab"), draw.choice([None, *map(str, range(500))]), i % 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v string, snapshot int")
    numbers = state = None
    for snapshot in range(3):
        part = df.where(F.col("snapshot") == snapshot)
        before = dict(map(tuple, numbers.collect())) if numbers else {}
        numbers = distinct.number_values(part, "v", numbers)
        now = dict(map(tuple, numbers.collect()))
        # numbers are unique, and once given they stay
        assert len(set(now.values())) == len(now) and before.items() <= now.items()
        fresh = distinct.distinct_state(part, ["g"], "v", numbers)
        state = fresh if state is None else distinct.merge_states(state.unionByName(fresh), ["g"])
    found = {r.g: r.n for r in distinct.count_state(state, ["g"], "n").collect()}
    assert found == {g: len({v for x, v, _ in rows if x == g and v is not None}) for g in "ab"}
    assert distinct.count_state(distinct.distinct_state(
        df.where("v IS NULL"), ["g"], "v", numbers), ["g"], "n").collect() == []
