"""Source divergence audit over a cube of (group block, group block, term block) cells (operator 11).

Terms are counted per (lang, source) group in one pass; each task sends one row per group and term.
A language keeps the terms of at least MIN_DOCS of its documents. Kept terms are dealt by hash to
term blocks of about TERMS, groups to group blocks of about GROUPS, and numbered within their
block, so no numbering passes through one task.

The counts of one group over one term block are a slice. Cell (a, b, t) owns the pairs of group
blocks a <= b over term block t: it receives the slices of both blocks (a slice goes to as many
cells as its language has group blocks), turns them into dense matrices of smoothed shares p, and
sums |p - q| for every pair of groups. Diagonal cells (a, a, t) also receive the language's own slice
and list the block's terms that lie furthest above the language. Partial sums are added, and
partial lists merged, along the term axis. A cell holds at most about 2 x GROUPS slices of TERMS
counts, whatever the corpus holds.

All arithmetic is on integers: p = 1 + floor(SHARE * (count + SMOOTH) / (N + SMOOTH * V)) by long
division. Null text, lang and source are ''; every (lang, source) that occurs is a group, also
without terms; a language without kept terms has divergence 0 between all its groups; equal rows
count each; an empty table gives no rows. Ranks order by value, then by the item's UTF-8 bytes.
Texts are counted as bytes, so a text takes about 60 bytes a word while it is split.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqlake.llm.rows import map_arrow, ship_package
from seqlake.operators.skew import lookup_join
from seqlake.session import materialize

MIN_DOCS, SMOOTH, SHARE, LIST_RANKS = 30, 5, 1_000_000_000, 50
#: Aimed size of a term block and of a group block.
TERMS, GROUPS = 4096, 64
#: Distinct (group, term) entries that a task holds before it sends them on.
HELD = 250_000
#: A term is a run of letters A-Z, a-z and bytes of characters beyond ASCII.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it) in parts to be added up, and one
    row with an empty term for every group of a part."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")],
                       text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        entries = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (counts, found) in held.items():
                counts[b""], found[b""] = 0, 0
                terms = list(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(terms)), pa.array([source] * len(terms)),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array([counts[w] for w in terms], pa.int64()),
                    pa.array([found[w] for w in terms], pa.int64())],
                    ["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for row, text in enumerate(batch.column("text")):
                counts, found = held.setdefault((langs[row], sources[row]), (Counter(), Counter()))
                # bytes.lower changes A-Z only
                words = TERM.findall(text.as_py().lower())
                before = len(counts)
                counts.update(words)
                found.update(set(words))
                entries += len(counts) - before + 1
                if entries > HELD:
                    yield from flush()
                    entries = 0
        yield from flush()

    return map_arrow(rows, run, "lang string, source string, term string, n bigint, docs bigint")


def number_in_blocks(items: DataFrame, item: str, size: int) -> DataFrame:
    """Deals the items of each language to blocks of about `size` and numbers them within their
    block in the items' order: adds block, blocks (of the language) and slot."""
    blocks = items.groupBy("lang").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    dealt = lookup_join(items, blocks, "lang", [item]) \
        .withColumn("block", F.pmod(F.xxhash64(item), F.col("blocks")).cast("int"))
    place = Window.partitionBy("lang", "block").orderBy(item)
    return dealt.withColumn("slot", F.row_number().over(place) - 1)


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SHARE * counts / total) for 0 <= counts <= total, without overflow."""
    if not total:  # no kept term, hence no counts
        return np.zeros(0, np.int64)
    if total >= 1 << 53:
        return np.array([1 + SHARE * int(c) // total for c in counts], np.int64)
    rest, out = counts.astype(np.int64), np.zeros(len(counts), np.int64)
    for _ in range(3):  # SHARE is 1000 ** 3
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest %= total
    return out + 1


def cell_rows(lang: str, a: int, b: int, table: pa.Table) -> Iterator[tuple]:
    """(source, part, item, value) of one cell, from its slices; rows without a group are the
    language's own slice."""
    column = {name: table.column(name).to_pylist() for name in
              ("source", "block", "width", "total", "terms_kept")}
    slots, ns = table.column("slots").combine_chunks(), table.column("ns").combine_chunks()

    def dense(row: int) -> np.ndarray:
        counts = np.full(column["width"][row], SMOOTH, np.int64)
        counts[slots[row].values.to_numpy()] += ns[row].values.to_numpy()
        return shares(counts, column["total"][row] + SMOOTH * column["terms_kept"][row])

    own = [i for i, block in enumerate(column["block"]) if block is None]
    left, right = ([i for i, block in enumerate(column["block"]) if block == side] for side in (a, b))
    if not left or not right:  # the hash left a group block empty
        return
    rows = {i: dense(i) for i in {*left, *right}}
    matrix = np.stack([rows[j] for j in right])
    for i in left:
        # 64-bit sums: p is at most SHARE + 1 and a block has some thousand terms
        for j, value in zip(right, np.abs(matrix - rows[i]).sum(1).tolist()):
            if i != j:
                yield column["source"][i], "pair", column["source"][j], value
            if a != b:
                yield column["source"][j], "pair", column["source"][i], value
    for row in own:
        terms = table.column("terms").combine_chunks()[row].as_py()
        q = dense(row)
        for i in left:
            p = rows[i]
            seen = np.sort(slots[i].values.to_numpy())
            above = seen[p[seen] > q[seen]]
            excess = p[above] - q[above]
            for at in np.argsort(-excess, kind="stable")[:LIST_RANKS].tolist():
                yield column["source"][i], "term", terms[above[at]], int(excess[at])


def _cells(vocabulary: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, part, item, value: sums and lists of single cells."""
    # one slice per group and term block of its language; a language without terms has block 0
    size = vocabulary.groupBy("lang", F.col("block").alias("t")).agg(F.count("*").cast("int").alias("width"))
    every = groups.withColumn("t", F.explode(F.sequence(F.lit(0), F.greatest("term_blocks", F.lit(1)) - 1)))
    packed = kept.groupBy("lang", "source", "t").agg(
        F.collect_list(F.struct(F.col("slot"), F.col("n"))).alias("held"))
    slices = every.join(size, ["lang", "t"], "left").join(packed, ["lang", "source", "t"], "left")
    other = F.sequence(F.lit(0), F.col("group_blocks") - 1)
    cell = F.explode(F.transform(other, lambda y: F.struct(
        F.least("block", y).alias("a"), F.greatest("block", y).alias("b"))))
    none = F.array().cast("array<struct<slot:int,n:bigint>>")
    columns = ["lang", "t", "cell.a", "cell.b", "source", "block", "width", "total", "terms_kept",
               F.col("held.slot").alias("slots"), F.col("held.n").alias("ns")]
    of_groups = slices.withColumn("held", F.coalesce("held", none)) \
        .withColumn("width", F.coalesce("width", F.lit(0))).withColumn("cell", cell) \
        .select(*columns, F.lit(None).cast("array<string>").alias("terms"))
    own = vocabulary.groupBy("lang", F.col("block").alias("t")).agg(
        F.array_sort(F.collect_list(F.struct("slot", F.col("total").alias("n"), "term"))).alias("held"))
    shape = groups.groupBy("lang").agg(
        F.max("group_blocks").alias("group_blocks"), F.max("lang_total").alias("total"),
        F.max("terms_kept").alias("terms_kept"))
    of_lang = lookup_join(own, shape, "lang", ["t"]).withColumn("block", F.lit(None).cast("int")) \
        .withColumn("source", F.lit(None).cast("string")) \
        .withColumn("width", F.size("held")) \
        .withColumn("cell", F.explode(F.transform(other, lambda y: F.struct(y.alias("a"), y.alias("b"))))) \
        .select(*columns, F.col("held.term").alias("terms"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lang, a, b, _ = (k.as_py() for k in key)
        rows = list(cell_rows(lang, a, b, table))
        source, part, item, value = zip(*rows) if rows else ((), (), (), ())
        return pa.table({
            "lang": pa.array([lang] * len(rows), pa.string()), "source": pa.array(source, pa.string()),
            "part": pa.array(part, pa.string()), "item": pa.array(item, pa.string()),
            "value": pa.array(value, pa.int64())})

    ship_package(kept.sparkSession)
    return of_groups.unionByName(of_lang).groupBy("lang", "a", "b", "t").applyInArrow(
        run, "lang string, source string, part string, item string, value bigint")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, terms_per_block: int = TERMS,
          groups_per_block: int = GROUPS) -> DataFrame:
    """lang, source, part, item, value, rank of every pair of groups and of the leading terms."""
    counts = materialize(
        count_terms(docs).groupBy("lang", "source", "term").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    common = counts.where("term <> ''").groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    vocabulary = materialize(
        number_in_blocks(materialize(common.drop("docs"), "divergence-terms"), "term", terms_per_block),
        "divergence-vocabulary")
    kept = materialize(
        counts.select("lang", "source", "term", "n").join(
            vocabulary.select("lang", "term", F.col("block").alias("t"), "slot"), ["lang", "term"])
        .drop("term"), "divergence-kept")
    in_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    found = counts.where("term = ''").select("lang", "source") \
        .join(in_group, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0)))
    in_lang = vocabulary.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.count("*").alias("terms_kept"),
        F.max("blocks").alias("term_blocks"))
    placed = number_in_blocks(materialize(found, "divergence-groups"), "source", groups_per_block) \
        .withColumnRenamed("blocks", "group_blocks")
    groups = materialize(
        lookup_join(placed, in_lang, "lang", ["source"]).fillna(
            0, ["lang_total", "terms_kept", "term_blocks"]), "divergence-shape")
    cells = materialize(_cells(vocabulary, groups, kept), "divergence-cells")
    pairs = cells.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(
        F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    return pairs.withColumn("rank", rank).unionByName(
        cells.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= LIST_RANKS))
