"""Removal of byte strings that occurred before, by suffix sorting (operator 1).

A byte goes if some LENGTH-byte string over it also starts earlier: in a document of smaller id, or
earlier in its own. Strings are judged on the input, so what is removed does not matter.

1. Texts that are equal as a whole are set apart: all but the first of them go completely (if they
   have LENGTH bytes at all), and only the first goes on.
2. Anchors: places whose GRAM-byte hash is least in some run of SPREAD places. Any LENGTH-byte string
   holds an anchor, and equal strings hold equal anchors at equal places, so equal strings meet under
   an anchor's hash. An occurrence is its hash, a hash of its context (all bytes of the
   LENGTH-byte strings around it) and its place. Within a task only the first occurrence of a
   context goes on, all later ones are known to be repeated as a whole; the rest meets by anchor.
3. Anchors with one context are done: every occurrence but the first is repeated as a whole. Where
   contexts differ, the first occurrence of each fetches its bytes.
4. Per task, the right contexts and the reversed left contexts form one sequence of symbols (ranks of
   UNIT-byte pieces), whose suffixes are sorted by grouping (`suffix_sort`). Neighbours in that order
   give the lengths of common prefixes, and these the classes of equal strings for every distance
   to the anchor. In each class all but the earliest are repeated.
5. Repeated strings are collected per document and their bytes removed.

Hot strings, however frequent, send one row per task and context. Only different contexts of one
anchor have to meet; they are at most as many as there are different texts around it.

Defined results: null text is empty; texts below LENGTH bytes keep all bytes; documents go by id,
null first, and those of one id by a hash of their text; rows that repeat both id and text are one
document and get the same result; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlake.llm.rows import map_arrow, map_rows, shuffle_partitions
from seqlake.llm.shingles import MIX_1, POWERS, U, mix
from seqlake.llm.suffix_sort import suffix_array
from seqlake.session import materialize

LENGTH = 100
GRAM = 36
SPREAD = LENGTH - GRAM + 1
SIDE = LENGTH - GRAM  # bytes of context on either side of an anchor's gram
UNIT, UNITS = 16, SIDE // 16
#: Occurrences that a map task holds before it deals them out.
HELD = 1 << 20
#: Hash buckets per shuffle partition: a task sorts one bucket at a time.
BUCKETS_PER_TASK = 4
#: Up to so many document keys (16 bytes each) are broadcast, more are joined by a shuffle.
BROADCAST_KEYS = 500_000
FIRST_ID = -(1 << 63)  # stands for a null id
PLACE = np.dtype([("h", "<u8"), ("c", "<u8"), ("doc", "<i8"), ("sub", "<i8"), ("at", "<i8")])
MARK = np.dtype([("doc", "<i8"), ("sub", "<i8"), ("at", "<i8")])


def _sliding(values: np.ndarray, size: int, better) -> np.ndarray:
    done = 1
    while done < size:
        step = min(done, size - done)
        values = better(values[:-step], values[step:])
        done += step
    return values


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, gram hashes and context hashes of a text's anchors."""
    n = len(data)
    if n < LENGTH:
        none = np.zeros(0, U)
        return none.astype(np.int64), none, none
    up, down = POWERS.upto(n)
    sums = np.concatenate((np.zeros(1, U), np.cumsum((data.astype(U) + U(1)) * up)))
    hashes = mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    least = _sliding(hashes, SPREAD, np.minimum)
    pad = np.zeros(SPREAD - 1, U)
    # a place is an anchor if it is the least of one of the runs over it
    most = _sliding(np.concatenate((pad, least, pad)), SPREAD, np.maximum)
    at = np.flatnonzero(most == hashes)
    begin, end = np.maximum(at - SIDE, 0), np.minimum(at + LENGTH, n)
    context = mix((sums[end] - sums[begin]) * down[begin])
    clipped = ((at - begin) * LENGTH + (end - at)).astype(U)
    return at, hashes[at], mix(context ^ clipped * MIX_1)


def _texts(docs: DataFrame) -> DataFrame:
    """doc, sub, key, text: the id without null, a hash that tells texts of one id apart, and a
    digest of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST_ID).cast("bigint")).alias("doc"),
        F.xxhash64(text).alias("sub"), F.md5(F.encode(text, "utf-8")).alias("key"),
        text.alias("text"))


def _without(docs: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """Anti or semi join that broadcasts `keys` only if they are few."""
    small = keys.count() <= BROADCAST_KEYS
    return docs.join(F.broadcast(keys) if small else keys, on, how)


def _in_order(rows: np.ndarray) -> np.ndarray:
    """Occurrences by anchor, context and place; one that rows of one document repeat counts once."""
    rows = rows[np.lexsort((rows["at"], rows["sub"], rows["doc"], rows["c"], rows["h"]))]
    new = np.ones(len(rows), bool)
    new[1:] = rows[1:] != rows[:-1]
    return rows[new]


def _deal_places(texts: DataFrame, buckets: int) -> DataFrame:
    """bucket, kind, blob: occurrences (kind 0) by anchor, marks (kind 1) by document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def deal() -> pa.RecordBatch:
            rows = _in_order(np.concatenate(held))
            first = np.ones(len(rows), bool)
            first[1:] = (rows["h"][1:] != rows["h"][:-1]) | (rows["c"][1:] != rows["c"][:-1])
            marks = rows[~first][["doc", "sub", "at"]].astype(MARK)
            out: tuple[list, list, list] = ([], [], [])
            for kind, part, by in ((0, rows[first], rows["h"][first]),
                                   (1, marks, mix(marks["doc"].astype(U) ^ marks["sub"].astype(U)))):
                where = (mix(by) % U(buckets)).astype(np.int64)
                order = np.argsort(where, kind="stable")
                found, starts = np.unique(where[order], return_index=True)
                for bucket, piece in zip(found, np.split(part[order], starts[1:])):
                    for column, value in zip(out, (int(bucket), kind, piece.tobytes())):
                        column.append(value)
            return pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()),
                 pa.array(out[2], pa.binary())], names=["bucket", "kind", "blob"])

        for batch in batches:
            for doc, sub, text in zip(batch["doc"].to_pylist(), batch["sub"].to_pylist(),
                                      batch["text"]):
                at, h, c = anchors(np.frombuffer(text.as_buffer(), np.uint8))
                if not len(at):
                    continue
                rows = np.empty(len(at), PLACE)
                rows["h"], rows["c"], rows["doc"], rows["sub"], rows["at"] = h, c, doc, sub, at
                held.append(rows)
                size += len(rows)
                if size >= HELD:
                    yield deal()
                    held, size = [], 0
        if held:
            yield deal()

    return map_arrow(
        texts.select("doc", "sub", "text"), run, "bucket int, kind int, blob binary")


def _by_bucket(dealt: DataFrame, partitions: int, schema: str, work) -> DataFrame:
    """`work(kinds, blobs)` on all blobs of one bucket at a time, yielding record batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, kinds, blobs = None, [], []
        for batch in batches:
            for bucket, kind, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != current and blobs:
                    yield from work(kinds, blobs)
                    kinds, blobs = [], []
                current = bucket
                kinds.append(kind)
                blobs.append(blob)
        if blobs:
            yield from work(kinds, blobs)

    ordered = dealt.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    return map_arrow(ordered.select("bucket", "kind", "blob"), run, schema)


def _judge_anchors(kinds: list[int], blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
    """doc, sub, at, h: h is null where the whole context is repeated, else the anchor's hash, whose
    other contexts have to be compared."""
    marks = np.frombuffer(b"".join(b for k, b in zip(kinds, blobs) if k), MARK)
    rows = _in_order(np.frombuffer(b"".join(b for k, b in zip(kinds, blobs) if not k), PLACE))
    new_h = np.ones(len(rows), bool)
    new_h[1:] = rows["h"][1:] != rows["h"][:-1]
    new_c = new_h.copy()
    new_c[1:] |= rows["c"][1:] != rows["c"][:-1]
    anchor = np.cumsum(new_h) - 1
    contexts = np.bincount(anchor[new_c], minlength=int(new_h.sum()))
    compare = new_c & (contexts[anchor] > 1) if len(rows) else new_c
    for at in range(0, max(len(marks), 1), 65536):
        part = marks[at : at + 65536]
        yield _places(part["doc"], part["sub"], part["at"], None)
    for keep, hashed in ((~new_c, False), (compare, True)):
        found = np.flatnonzero(keep)
        for at in range(0, len(found), 65536):
            part = rows[found[at : at + 65536]]
            yield _places(part["doc"], part["sub"], part["at"],
                          part["h"].view(np.int64) if hashed else None)


def _places(doc, sub, at, h) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(x)) for x in (doc, sub, at)]
        + [pa.nulls(n, pa.int64()) if h is None else pa.array(np.ascontiguousarray(h))],
        names=["doc", "sub", "at", "h"])


def _fetch_contexts(texts: DataFrame, asked: DataFrame, buckets: int) -> DataFrame:
    """bucket, kind, blob: hash, place and bytes of contexts, dealt out by anchor."""
    width = 2 * SIDE
    record = np.dtype([*PLACE.descr, ("left", "<i8"), ("right", "<i8"), ("bytes", f"V{width}")])
    per_doc = asked.groupBy("doc", "sub").agg(F.collect_list(F.struct("at", "h")).alias("wanted"))
    per_doc = materialize(per_doc, "contexts")
    found = _without(texts.select("doc", "sub", "text"), per_doc.select("doc", "sub"),
                     ["doc", "sub"], "left_semi").dropDuplicates(["doc", "sub"])
    rows = found.join(per_doc, ["doc", "sub"]).select("doc", "sub", "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch["text"][i].as_buffer().to_pybytes()
                wanted = batch["wanted"][i].as_py()
                at = np.array([w["at"] for w in wanted], np.int64)
                out = np.zeros(len(at), record)
                out["doc"], out["sub"] = batch["doc"][i].as_py(), batch["sub"][i].as_py()
                out["at"], out["h"] = at, np.array([w["h"] for w in wanted], np.int64).view(U)
                padded = np.zeros(len(data) + 2 * LENGTH, np.uint8)
                padded[LENGTH:-LENGTH] = np.frombuffer(data, np.uint8)
                # reversed bytes left of the gram, then bytes right of it
                side = np.arange(SIDE)
                left = padded[LENGTH + at[:, None] - 1 - side]
                right = padded[LENGTH + at[:, None] + GRAM + side]
                out["left"] = np.minimum(at, SIDE)
                out["right"] = np.minimum(len(data) - at - GRAM, SIDE)
                both = np.ascontiguousarray(np.concatenate((left, right), 1))
                out["bytes"] = both.view(f"V{width}")[:, 0]
                where = (mix(out["h"]) % U(buckets)).astype(np.int64)
                order = np.argsort(where, kind="stable")
                keys, starts = np.unique(where[order], return_index=True)
                pieces = [p.tobytes() for p in np.split(out[order], starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int32()), pa.array([0] * len(keys), pa.int32()),
                     pa.array(pieces, pa.binary())], names=["bucket", "kind", "blob"])

    return map_arrow(rows, run, "bucket int, kind int, blob binary")


def sort_contexts(anchor: np.ndarray, sides: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """For each side: contexts in order of anchor and bytes, by one suffix array over all sides.

    anchor: number per context; sides: contexts x 2 x SIDE bytes, zero after their length."""
    n = len(anchor)
    words = sides.reshape(n, 2, UNITS, UNIT // 8, 8).copy().view(">u8").reshape(-1, UNIT // 8)
    order = np.lexsort((words[:, 1], words[:, 0]))
    change = np.ones(len(order), bool)
    change[1:] = (words[order][1:] != words[order][:-1]).any(1)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(change)
    base_rank = SIDE + 1
    base_anchor = base_rank + int(rank.max(initial=0)) + 1
    per = UNITS + 2
    symbols = np.empty((n, 2, per), np.int64)
    symbols[:, :, 0] = base_anchor + 2 * anchor[:, None] + np.arange(2)
    symbols[:, :, 1:-1] = base_rank + rank.reshape(n, 2, UNITS)
    symbols[:, :, -1] = 1 + lengths  # of equal bytes the shorter context comes first
    found = np.array(suffix_array([*symbols.ravel().tolist(), 0]))
    starts = found[(found % per == 0) & (found < n * 2 * per)] // per
    return [starts[starts % 2 == side] // 2 for side in (0, 1)]


def _judge_contexts(kinds: list[int], blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
    """doc, sub, starts: starts of repeated strings, from all contexts of a bucket's anchors."""
    width = 2 * SIDE
    record = np.dtype([*PLACE.descr, ("left", "<i8"), ("right", "<i8"), ("bytes", f"V{width}")])
    rows = np.frombuffer(b"".join(blobs), record)
    rows = rows[np.lexsort((rows["at"], rows["sub"], rows["doc"]))]  # earliest first
    n = len(rows)
    _, anchor = np.unique(rows["h"], return_inverse=True)
    sides = np.frombuffer(np.ascontiguousarray(rows["bytes"]).tobytes(), np.uint8) \
        .reshape(n, 2, SIDE)
    lengths = np.stack((rows["left"], rows["right"]), 1)
    common = []
    for side, order in enumerate(sort_contexts(anchor, sides, lengths)):
        a, b = order[:-1], order[1:]
        same = np.hstack((sides[a, side] == sides[b, side], np.zeros((n - 1, 1), bool)))
        shared = np.minimum(np.argmin(same, 1), np.minimum(lengths[a, side], lengths[b, side]))
        shared[anchor[a] != anchor[b]] = -1
        common.append((order, shared))
    starts: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    for left in range(SIDE + 1):
        right = SIDE - left
        key = np.zeros(n, np.int64)
        for (order, shared), need in zip(common, (left, right)):
            classes = np.empty(n, np.int64)
            classes[order] = np.concatenate(([0], np.cumsum(shared < need)))
            key = key * n + classes
        fits = np.flatnonzero((lengths[:, 0] >= left) & (lengths[:, 1] >= right))
        _, first = np.unique(key[fits], return_index=True)
        again = np.ones(len(fits), bool)
        again[first] = False
        owner.append(fits[again])
        starts.append(rows["at"][fits[again]] - left)
    who, start = np.concatenate(owner), np.concatenate(starts)
    order = np.argsort(who, kind="stable")
    who, start = who[order], start[order]
    found, cut = np.unique(who, return_index=True)
    if len(found):
        runs = [runs_of(p) for p in np.split(start, cut[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(rows["doc"][found])),
             pa.array(np.ascontiguousarray(rows["sub"][found])),
             pa.array(runs, pa.list_(pa.int64()))], names=["doc", "sub", "runs"])


def runs_of(starts: np.ndarray) -> list[int]:
    """First and last of each run of consecutive numbers, one after the other."""
    starts = np.unique(starts)
    gap = np.flatnonzero(np.diff(starts) > 1)
    first = starts[np.concatenate(([0], gap + 1))]
    last = starts[np.concatenate((gap, [len(starts) - 1]))]
    return np.stack((first, last), 1).ravel().tolist()


def removed_spans(n: int, whole: list[int], runs: list[list[int]]) -> np.ndarray:
    """Begin and end of the maximal removed runs of a text of n bytes. whole: anchors whose context
    is repeated; runs: first and last starts of further repeated strings."""
    change = np.zeros(n + 1, np.int64)
    at = np.array(whole, np.int64)
    flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 2)
    first = np.concatenate((np.maximum(at - SIDE, 0), flat[:, 0]))
    last = np.concatenate((np.minimum(at, n - LENGTH), flat[:, 1]))
    np.add.at(change, first, 1)
    np.add.at(change, last + LENGTH, -1)
    covered = np.concatenate(([False], np.cumsum(change[:-1]) > 0, [False]))
    return np.flatnonzero(covered[1:] != covered[:-1]).reshape(-1, 2)


def find_repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents whose whole text occurred before (doc, sub), and per other document the repeated
    parts (doc, sub, whole, runs)."""
    spark = docs.sparkSession
    texts = _texts(docs)
    partitions = shuffle_partitions(spark)
    buckets = partitions * BUCKETS_PER_TASK
    ids = texts.select("doc", "sub", "key")
    firsts = ids.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last")) \
        .where("first < last").select("key", "first")
    copies = materialize(
        ids.join(firsts, "key").where("doc > first").select("doc", "sub").distinct(), "copies")
    # rows that repeat both id and text only add equal occurrences of one place
    unique = _without(texts, copies, ["doc", "sub"], "left_anti")
    places = materialize(
        _by_bucket(_deal_places(unique, buckets), partitions,
                   "doc bigint, sub bigint, at bigint, h bigint", _judge_anchors), "places")
    contexts = _fetch_contexts(unique, places.where("h is not null"), buckets)
    compared = _by_bucket(contexts, partitions, "doc bigint, sub bigint, runs array<bigint>",
                          _judge_contexts)
    empty = F.array().cast("array<bigint>")
    parts = places.where("h is null").select("doc", "sub", F.col("at").alias("whole"),
                                             F.lit(None).cast("array<bigint>").alias("runs")) \
        .unionAll(compared.select("doc", "sub", F.lit(None).cast("bigint").alias("whole"), "runs"))
    per_doc = parts.groupBy("doc", "sub").agg(
        F.coalesce(F.collect_list("whole"), empty).alias("whole"),
        F.collect_list("runs").alias("runs"))
    return copies, materialize(per_doc, "repeats")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans of every row of `docs`; spans are
    begin and end bytes of the maximal removed runs, one after the other."""
    copies, repeats = find_repeats(docs)
    schema = ("doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
              "spans array<bigint>")

    def cut(doc, text, copied, whole, runs):
        out: list[list] = [[] for _ in range(6)]
        for d, t, gone, at, more in zip(doc, text, copied, whole, runs):
            data = t.encode()
            n = len(data)
            if gone:
                spans = np.array([[0, n]]) if n >= LENGTH else np.zeros((0, 2), np.int64)
            elif at or more:
                spans = removed_spans(n, at or [], more or [])
            else:
                spans = np.zeros((0, 2), np.int64)
            digest, before = hashlib.sha256(), 0
            for begin, end in spans.tolist():
                digest.update(data[before:begin])
                before = end
            digest.update(data[before:])
            row = (d, n, int((spans[:, 1] - spans[:, 0]).sum()), len(spans), digest.hexdigest(),
                   spans.ravel().tolist())
            for column, value in zip(out, row):
                column.append(value)
        return out

    texts = _texts(docs).select("doc", "sub", "text")
    touched = materialize(
        copies.select("doc", "sub", F.lit(True).alias("copied"))
        .unionAll(repeats.select("doc", "sub", F.lit(False).alias("copied"))), "touched")
    none = F.lit(None)
    # texts without any repeated part are not shuffled
    clean = _without(texts, touched.select("doc", "sub"), ["doc", "sub"], "left_anti").select(
        "doc", "text", F.lit(False).alias("copied"), none.cast("array<bigint>").alias("whole"),
        none.cast("array<array<bigint>>").alias("runs"))
    rest = _without(texts, touched.select("doc", "sub"), ["doc", "sub"], "left_semi") \
        .join(touched, ["doc", "sub"]).join(repeats, ["doc", "sub"], "left") \
        .select("doc", "text", "copied", "whole", "runs")
    rows = map_rows(clean, schema, lambda: cut).unionAll(map_rows(rest, schema, lambda: cut))
    doc_id = F.when(F.col("doc") != FIRST_ID, F.col("doc"))
    return rows.withColumn("doc_id", doc_id).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
