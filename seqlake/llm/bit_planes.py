"""Centroid clustering on bit planes (operator 12).

A component x becomes the integer floor(scale * x). The integers of a vector are stored as bit
planes: plane i holds bit i of all 64 components in one unsigned 64-bit word, the last plane in
two's complement the sign. With plane weights w (powers of two, the sign's negative) the dot product
of a vector X and a centroid C is the sum of w[i] * w[j] * popcount(X[i] & C[j]), so a squared
distance |X|^2 - 2 X.C + |C|^2 is exact. As many planes are stored as the table's widest integer
needs.

Packed vectors are written once. A round is one pass over them with the centroids in its closure
(k x planes words); tasks return one row of sums per cluster, Spark adds them, and the driver
receives k x 64 sums. Nothing else is collected, broadcast or shuffled by vector, so copies and
crowded clusters cost no more than other rows.

Defined results: vectors that are null, of another length, or hold a null or non-finite component
have no row in the result; repeated rows are vectors of their own, and so are rows with a null id,
whose text is empty. Rows of equal id start in the order of their components. Fewer vectors than
centroids make fewer centroids, and none an empty result. An integer beyond 2**27 in magnitude stops the
query with an error that says so, as squared distances then no longer fit a 64-bit integer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlake.llm.rows import map_arrow
from seqlake.session import materialize

COMPONENTS = 64
LARGEST = 1 << 27
#: Rows that are packed or compared at a time.
SLICE = 8192


def pack(integers: np.ndarray, planes: int) -> np.ndarray:
    """n x 64 integers as n x planes words."""
    bits = (integers[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def unpack(words: np.ndarray) -> np.ndarray:
    """n x planes words as n x planes x 64 bits."""
    parts = np.ascontiguousarray(words.astype("<u8")).view(np.uint8)
    return np.unpackbits(parts.reshape(*words.shape, 8), axis=2, bitorder="little")


def weights(planes: int) -> np.ndarray:
    w = np.int64(1) << np.arange(planes, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def dot_products(words: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Dot products of n packed vectors with one packed centroid by weighted AND-popcounts."""
    w = weights(words.shape[1])
    total = np.zeros(len(words), np.int64)
    for i in range(words.shape[1]):
        column = words[:, i]
        for j in range(words.shape[1]):
            total += np.bitwise_count(column & centroid[j]).astype(np.int64) * (w[i] * w[j])
    return total


def nearest(words: np.ndarray, norms: np.ndarray, centroids: np.ndarray,
            packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster (of equal ones the smallest) and squared distance of every packed vector."""
    distances = np.stack([
        norms - 2 * dot_products(words, packed[k]) + int(centroids[k] @ centroids[k])
        for k in range(len(centroids))])
    cluster = distances.argmin(0)
    return cluster, distances[cluster, np.arange(len(words))]


def component_sums(words: np.ndarray, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of every cluster and their sums by component, from bit counts by plane."""
    w, bits = weights(words.shape[1]), unpack(words)
    counts = np.bincount(cluster, minlength=k)
    sums = np.zeros((k, COMPONENTS), np.int64)
    for c in np.flatnonzero(counts):
        sums[c] = w @ bits[cluster == c].sum(0, dtype=np.int64)
    return counts, sums


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def _integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(scale * x.cast("double")))


def kept_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id and vector of the rows with 64 finite components."""
    vector = F.col(vector_column).cast("array<double>")
    # NaN is the largest double in Spark, so this leaves out NaN and both infinities
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return vectors.select(F.col(id_column).alias("id"), vector.alias("vector")) \
        .where((F.size("vector") == COMPONENTS) & finite)


def planes_needed(kept: DataFrame, scale: int) -> int:
    bounds = kept.agg(
        F.max(F.array_max("vector")).alias("high"), F.min(F.array_min("vector")).alias("low")).first()
    if bounds["high"] is None:
        return 1
    low, high = np.floor(scale * bounds["low"]), np.floor(scale * bounds["high"])
    if max(abs(low), abs(high)) > LARGEST:
        raise ValueError(f"Components times {scale} must lie within -2**27 and 2**27 for exact distances")
    return int(max(-int(low) - 1, int(high), 0)).bit_length() + 1


def pack_vectors(kept: DataFrame, planes: int, scale: int) -> DataFrame:
    """id, words (bit planes) and norm (squared) of every kept vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                whole = np.floor(scale * _matrix(part.column("vector"), np.float64, COMPONENTS))
                integers = whole.astype(np.int64)
                words = pack(integers, planes).astype(np.uint64).view(np.int64)
                offsets = np.arange(0, words.size + 1, planes, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column("id"),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(words.ravel())),
                    pa.array(np.einsum("ij,ij->i", integers, integers))], ["id", "words", "norm"])

    id_type = kept.schema["id"].dataType.simpleString()
    return map_arrow(kept, run, f"id {id_type}, words array<bigint>, norm bigint")


def first_centroids(kept: DataFrame, k: int, scale: int, seed: str) -> np.ndarray:
    """The integers of the k vectors whose ids have the smallest digests, in that order."""
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = kept.select(digest.alias("digest"), _integers(F.col("vector"), scale).alias("integers")) \
        .orderBy("digest", "integers").limit(k).collect()
    return np.array([r["integers"] for r in rows], np.int64).reshape(-1, COMPONENTS)


def _assignment(packed: DataFrame, centroids: np.ndarray, planes: int, schema: str, emit) -> DataFrame:
    """`emit(part, words, cluster, distance)` for slices of packed vectors, None at a task's end."""
    centroid_words = pack(centroids, planes).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = emit()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                words = _matrix(part.column("words"), np.int64, planes).view(np.uint64)
                norms = part.column("norm").to_numpy()
                out = step(part, words, *nearest(words, norms, centroids, centroid_words))
                if out is not None:
                    yield out
        out = step(None, None, None, None)
        if out is not None:
            yield out

    return map_arrow(packed, run, schema)


def next_centroids(packed: DataFrame, centroids: np.ndarray, planes: int) -> np.ndarray:
    """Floored means of the vectors nearest to each centroid; centroids without any stay."""
    k = len(centroids)

    def emit():
        counts, sums = np.zeros(k, np.int64), np.zeros((k, COMPONENTS), np.int64)

        def step(part, words, cluster, distance):
            nonlocal counts, sums
            if part is not None:
                n, s = component_sums(words, cluster, k)
                counts, sums = counts + n, sums + s
                return None
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(k, dtype=np.int32)), pa.array(counts), pa.array(list(sums))],
                ["cluster", "n", "sums"])
        return step

    partial = _assignment(packed, centroids, planes, "cluster int, n bigint, sums array<bigint>", emit)
    exact = "decimal(38,0)"
    rows = partial.select("cluster", F.col("n").cast(exact).alias("n"), F.posexplode("sums")) \
        .groupBy("cluster", "pos").agg(
            F.sum(F.col("col").cast(exact)).alias("total"), F.sum("n").alias("n")).collect()
    out = centroids.copy()
    for r in rows:  # k x 64 rows
        if r["n"]:
            out[r["cluster"], r["pos"]] = int(r["total"]) // int(r["n"])
    return out


def fit(packed: DataFrame, centroids: np.ndarray, planes: int, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        centroids = next_centroids(packed, centroids, planes)
    return centroids


def assign(packed: DataFrame, centroids: np.ndarray, planes: int) -> DataFrame:
    """id, cluster and squared distance of every packed vector."""
    id_type = packed.schema["id"].dataType.simpleString()

    def emit():
        def step(part, words, cluster, distance):
            return None if part is None else pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                ["id", "cluster", "distance"])
        return step

    return _assignment(
        packed, centroids, planes, f"id {id_type}, cluster int, distance bigint", emit)


def cluster(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
            k: int = 16, rounds: int = 3, scale: int = 64, seed: str = "1") -> tuple[DataFrame, DataFrame]:
    """Assignments (id, cluster, distance) and centroids (cluster, components array<bigint>)."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, id_column, vector_column)
    planes = planes_needed(kept, scale)
    packed = materialize(pack_vectors(kept, planes, scale), "bit-planes")
    centroids = fit(packed, first_centroids(kept, k, scale, seed), planes, rounds)
    table = spark.createDataFrame(
        [(i, [int(x) for x in c]) for i, c in enumerate(centroids)],
        "cluster int, components array<bigint>")
    if not len(centroids):
        return packed.selectExpr("id", "0 AS cluster", "norm AS distance"), table
    return assign(packed, centroids, planes), table


def cluster_digests(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    assigned, centroids = cluster(vectors)
    assigned = materialize(assigned, "bit-plane-clusters")
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # one row per cluster, k at most
    total = inertia.agg(F.sum("cluster_inertia").alias("inertia"))
    digest = F.sha2(F.array_join(F.col("components").cast("array<string>"), ","), 256)
    sums = inertia.join(centroids.select("cluster", digest.alias("centroid_sha256")), "cluster") \
        .select("*", total.scalar().alias("inertia"))
    return assigned.join(F.broadcast(sums), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256")
