"""Near-duplicate documents by MinHash bands and odd sketches (operator 10).

1. Each text becomes its shingle set. Equal sets are one node from here on, so exact copies, however
   many, cost one row per task.
2. SAMPLES MinHash values are cut into BANDS bands; nodes that agree in a band share a bucket. A
   link of similarity 0.8 shares no bucket with probability below 1e-7.
3. The MinHash samples are folded into a parity bitmap, the odd sketch: the population count of the
   exclusive or of two sketches estimates the similarity. In every bucket each node meets the
   bucket's least and greatest node by one of some hashes; its most similar one above SKETCH_FLOOR is confirmed on the
   full sets. A true link falls below that floor with probability below 1e-8.
4. Buckets that still hold several components are compared in tiles of bounded size: the nodes
   outside the bucket's largest component against all of its nodes. Here the parity bitmap holds the
   whole set: its population count never exceeds the true difference, so a pair whose bound is
   below the limit is no link, without any chance of error. Of the possible pairs, a spanning forest
   over the components, most similar pairs first, goes to confirmation, and a number of the most similar
   others that doubles with each round. Confirmed pairs join their
   components, refuted ones are passed over, and the nodes that had other possible pairs meet again, bucket
   by bucket, until no possible pair between two components is left.
5. Confirmed links are joined into components by alternating stars in Spark.

Pairs within a group are thus never all emitted: a group is first contracted by one link per node.

Defined results: null text, or a text without words, has the empty set and is linked with nothing;
rows with equal texts are linked, whatever their ids; a component's id is the least doc_id in it
(null if all are null; `kept` is then null); an empty table gives an empty result. Sets are held as
64-bit hashes; two different sets with one node hash are noticed by a second hash and stop the job.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlake.llm.components import components
from seqlake.llm.rows import map_groups, map_rows, shuffle_partitions
from seqlake.llm.shingles import U, mix, shingle_set
from seqlake.session import materialize

SAMPLES, BANDS = 128, 32
SKETCH_BITS, SKETCH_FLOOR = 512, 0.55
#: Bits per shingle of the whole-set bitmap.
PARITY_BITS = 8
#: Orders by which buckets choose the two nodes that all their nodes meet.
LEADER_HASHES = 8
#: Nodes and bitmap bytes of a tile's side.
TILE_NODES, TILE_BYTES = 2048, 4 << 20
#: Up to so many ids (8 bytes each) are broadcast, more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
_RANDOM = np.random.default_rng(20_10)
_FACTOR = _RANDOM.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_TERM = _RANDOM.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash samples of a non-empty set."""
    x = (hashes >> U(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 256):
        part = x[at : at + 256, None] * _FACTOR
        part += _TERM
        np.minimum(least, part.min(0), out=least)
    return least


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(BANDS, -1).astype(U)
    key = np.arange(BANDS, dtype=U)
    for column in rows.T:
        key = mix(key * U(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def odd_sketch(samples: np.ndarray) -> bytes:
    """Parity bitmap of the (place, sample) pairs."""
    bits = mix(samples.astype(U) + (np.arange(SAMPLES, dtype=U) << U(32))) % U(SKETCH_BITS)
    return _bitmap(bits, SKETCH_BITS)


def parity(hashes: np.ndarray) -> bytes:
    """Parity bitmap of a whole set. Its size is a power of two, so a longer one is folded onto a
    shorter one by the exclusive or of its parts."""
    bits = max(128, 1 << int(PARITY_BITS * len(hashes) - 1).bit_length())
    return _bitmap(hashes & U(bits - 1), bits)


def _bitmap(bits: np.ndarray, size: int) -> bytes:
    odd = np.bincount(bits.astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketch_similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of rows of sketches (arrays of uint64)."""
    differing = np.bitwise_count(a ^ b).sum(-1)
    share = np.minimum(2 * differing / SKETCH_BITS, 1 - 1e-9)
    return 1 + SKETCH_BITS / 2 * np.log1p(-share) / (2 * SAMPLES)


def sketch_documents(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_key (hash of the text), node (null for an empty set), twin (a second hash), n,
    bands, sketch, bitmap."""
    def start():
        def step(doc_id, text_key, text):
            out: list[list] = [[] for _ in range(8)]
            for d, key, t in zip(doc_id, text_key, text):
                hashes = shingle_set(t, words)
                row = [d, key, None, None, len(hashes), None, None, None]
                if len(hashes):
                    data, samples = hashes.tobytes(), signature(hashes)
                    row[2] = xxhash.xxh3_64_intdigest(data) - (1 << 63)
                    row[3] = xxhash.xxh64_intdigest(data) - (1 << 63)
                    row[5:] = band_keys(samples), odd_sketch(samples), parity(hashes)
                for column, value in zip(out, row):
                    column.append(value)
            return out
        return step

    return map_rows(
        docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"),
        "doc_id bigint, text_key bigint, node bigint, twin bigint, n bigint, bands array<bigint>, sketch binary, "
        "bitmap binary", start)


def _meetings(members: DataFrame, buckets: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b, similarity: each node with the least and the greatest node of its buckets, where the
    odd sketches leave a link possible."""
    met = members.join(buckets, "bucket").select(
        "node", F.explode(F.array("low", "high")).alias("leader")).where("node <> leader").select(
        F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    side = lambda name: nodes.select(F.col("node").alias(name), F.col("sketch").alias(f"s{name}"))
    pairs = met.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb")

    def start():
        def step(a, b, sa, sb):
            if not a:
                return [], [], []
            read = lambda s: np.frombuffer(b"".join(s), U).reshape(len(s), -1)
            like = sketch_similarity(read(sa), read(sb))
            keep = np.flatnonzero(like >= SKETCH_FLOOR)
            return np.array(a)[keep], np.array(b)[keep], like[keep]
        return step

    return map_rows(pairs, "a bigint, b bigint, similarity double", start)


def confirm(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) \
        -> DataFrame:
    """a, b, link: `pairs` judged on the full shingle sets of their texts."""
    spark = docs.sparkSession
    pairs = materialize(pairs, "pairs")
    asked = materialize(
        pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        .join(nodes.select("node", "doc_id"), "node"), "asked")
    ids = asked.select(F.col("doc_id").alias("asked_id"), "node")
    ids = F.broadcast(ids) if asked.count() <= BROADCAST_IDS else ids
    texts = docs.select("doc_id", "text") \
        .join(ids, F.col("doc_id").eqNullSafe(F.col("asked_id"))).select("node", "text")

    def own():
        def step(node, text):
            keep = [i for i, t in enumerate(text)
                    if xxhash.xxh3_64_intdigest(shingle_set(t, words).tobytes()) - (1 << 63)
                    == node[i]]
            return [node[i] for i in keep], [text[i] for i in keep]
        return step

    texts = map_rows(texts, "node bigint, text string", own)  # not a row with a repeated id
    texts = materialize(texts.dropDuplicates(["node"]), "texts")
    side = lambda name: texts.select(F.col("node").alias(name), F.col("text").alias(f"t{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")

    def start():
        def step(a, b, ta, tb):
            link = []
            for x, y in zip(ta, tb):
                x, y = shingle_set(x, words), shingle_set(y, words)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                link.append(100 * shared >= percent * (len(x) + len(y) - shared))
            return a, b, link
        return step

    return materialize(map_rows(both, "a bigint, b bigint, link boolean", start), "judged")


def _fold(rows: np.ndarray, width: int) -> np.ndarray:
    return np.bitwise_xor.reduce(rows.reshape(len(rows), -1, width), axis=1)


def _forest(order: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Numbers of the pairs of a spanning forest over components x and y, `order` giving the most
    similar pairs first: every component takes its first pair, until none is left between two."""
    root = np.arange(int(max(x.max(), y.max())) + 1)
    pair, x, y = order, x[order], y[order]
    taken: list[np.ndarray] = []
    while len(pair):
        first = np.full(len(root), len(pair))
        np.minimum.at(first, x, np.arange(len(pair)))
        np.minimum.at(first, y, np.arange(len(pair)))
        chosen = np.unique(first[first < len(pair)])
        taken.append(pair[chosen])
        for i, j in zip(x[chosen].tolist(), y[chosen].tolist()):
            while root[i] != i:
                i = int(root[i])
            while root[j] != j:
                j = int(root[j])
            root[max(i, j)] = min(i, j)
        while (root[root] != root).any():
            root = root[root]
        x, y = root[x], root[y]
        apart = x != y
        pair, x, y = pair[apart], x[apart], y[apart]
    return np.concatenate(taken)


def compare_tile(rows: list[dict], percent: int, further: int = 0):
    """Pairs (a, b) of one tile to confirm, with the tile's bucket: a spanning forest of its possible
    pairs over their components, and the `further` most similar ones. `left` rows meet `right` rows and
    each other; refuted pairs are passed over. Nodes of possible pairs that are not among these follow
    as (node, None), with the bucket: only they can have something left to confirm."""
    node = np.array([r["node"] for r in rows])
    n = np.array([r["n"] for r in rows])
    is_left = np.array([r["left"] for r in rows])
    _, component = np.unique([r["component"] for r in rows], return_inverse=True)
    width = np.array([len(r["bitmap"]) // 8 for r in rows])
    bitmaps = {int(w): np.frombuffer(b"".join(rows[i]["bitmap"] for i in np.flatnonzero(width == w)),
                                     U).reshape(-1, w) for w in np.unique(width)}
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for w in bitmaps:
        # sizes of linked sets differ by less than a factor of two, so do their bitmaps
        for other_w in (w // 2, w, w * 2):
            if other_w not in bitmaps:
                continue
            common = min(w, other_w)
            mine, others = np.flatnonzero(width == w), np.flatnonzero(width == other_w)
            their_bits = _fold(bitmaps[other_w], common)
            for i, bits in zip(mine, _fold(bitmaps[w], common)):
                if not is_left[i]:
                    continue
                z = np.bitwise_count(their_bits ^ bits).sum(1).astype(np.int64)
                total = n[others] + n[i]
                most_shared = (total - z) // 2
                possible = 100 * most_shared >= percent * (total - most_shared)
                possible &= component[others] != component[i]
                possible &= ~is_left[others] | (node[others] > node[i])  # each pair once
                if rows[i]["refuted"]:
                    possible &= ~np.isin(node[others], rows[i]["refuted"])
                k = np.flatnonzero(possible)
                if len(k):
                    size = 64 * common
                    share = np.minimum(2 * z[k] / size, 1 - 1e-9)
                    found.append((-size * np.log1p(-share) / total[k],
                                  np.full(len(k), i), others[k]))
    if not found:
        return
    difference, a, b = (np.concatenate(column) for column in zip(*found))
    order = np.lexsort((node[b], node[a], difference))
    asked = np.union1d(_forest(order, component[a], component[b]), order[:further])
    bucket = rows[0]["bucket"]
    for k in asked:
        x, y = int(node[a[k]]), int(node[b[k]])
        yield min(x, y), max(x, y), bucket
    waiting = np.ones(len(order), bool)
    waiting[asked] = False
    for x in np.unique(node[np.concatenate((a[waiting], b[waiting]))]).tolist():
        yield x, None, bucket


def _tiles(
    members: DataFrame, known: DataFrame, nodes: DataFrame, tested: DataFrame
) -> DataFrame:
    """Rows of tiles: the nodes of a bucket outside its largest component (`left`) in blocks,
    against blocks of all its nodes. Each row knows with whom it was refuted."""
    held = members.join(known, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component"))
    per = held.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    largest = per.groupBy("bucket").agg(
        F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("several")) \
        .where("several > 1").drop("several")
    refuted = tested.where("not link").select(
        F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                          F.struct(F.col("b").alias("node"), F.col("a").alias("other"))))
        .alias("p")).groupBy("p.node").agg(F.collect_set("p.other").alias("refuted"))
    bitmap = nodes.select("node", "n", "bitmap")
    rows = held.join(largest, "bucket").join(bitmap, "node").join(refuted, "node", "left").select(
        "bucket", "node", "component", "n", "bitmap", "refuted",
        (F.col("component") != F.col("top.component")).alias("left"))
    amount = rows.groupBy("bucket", "left").agg(
        F.ceil(F.greatest(F.count("*") / TILE_NODES,
                          F.sum(F.length("bitmap")) / TILE_BYTES)).alias("blocks"))
    blocks = amount.groupBy("bucket").agg(
        F.max(F.when(F.col("left"), F.col("blocks"))).alias("l_blocks"),
        F.max(F.when(~F.col("left"), F.col("blocks"))).alias("r_blocks"))
    dealt = rows.join(blocks, "bucket").withColumn("block", F.pmod(
        F.xxhash64("node"), F.when(F.col("left"), F.col("l_blocks")).otherwise(F.col("r_blocks"))))
    # left block i meets left blocks j >= i (tile i, j) and every right block r (tile i, -1 - r)
    left_lefts = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("l_blocks") - 1), lambda j:
                             F.struct(F.least(F.col("block"), j).alias("i"),
                                      F.greatest(F.col("block"), j).alias("j")))
    left_rights = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("r_blocks") - 1), lambda r:
                              F.struct(F.col("block").alias("i"), (-1 - r).alias("j")))
    rights = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("l_blocks") - 1), lambda i:
                         F.struct(i.alias("i"), (-1 - F.col("block")).alias("j")))
    places = F.when(F.col("left"), F.concat(left_lefts, left_rights)).otherwise(rights)
    return dealt.withColumn("place", F.explode(places)).select(
        F.xxhash64("bucket", "place.i", "place.j").alias("tile"), "bucket",
        # in a tile of two different left blocks or of a left and a right block only pairs across
        # count; pairs within a block have their own tile
        "node", "component", "n", "bitmap", "refuted", "left")


def link_nodes(docs: DataFrame, sketches: DataFrame, words: int, percent: int) -> DataFrame:
    """node, component of all nodes that are linked with another node."""
    spark = docs.sparkSession
    spread = sketches.where("node is not null").select("node", F.explode("bands").alias("bucket"))
    # The least and greatest node by a hash with one of LEADER_HASHES salts: buckets of one large group
    # hold much the same nodes, and with one order for all of them a node would meet the same two.
    order = F.xxhash64("node", F.pmod("bucket", F.lit(LEADER_HASHES)))
    buckets = materialize(
        spread.groupBy("bucket").agg(
            F.min_by("node", order).alias("low"), F.max_by("node", order).alias("high"))
        .where("low <> high"), "buckets")
    members = materialize(
        spread.join(buckets.select("bucket"), "bucket").select("bucket", "node").distinct(),
        "members")
    nodes = materialize(
        sketches.join(members.select("node").distinct(), "node", "left_semi")
        .select("node", "doc_id", "n", "sketch", "bitmap").dropDuplicates(["node"]), "nodes")

    met = materialize(_meetings(members, buckets, nodes), "meetings")
    each = met.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("other"), "similarity"),
        F.struct(F.col("b").alias("node"), F.col("a").alias("other"), "similarity"))).alias("m"))
    best = each.groupBy("m.node").agg(
        F.max(F.struct("m.similarity", "m.other")).alias("m")).select(
        F.least("node", "m.other").alias("a"), F.greatest("node", "m.other").alias("b")).distinct()
    tested = confirm(best, nodes, docs, words, percent)
    known = materialize(components(tested.where("link").select("a", "b")), "components")

    # buckets of two nodes have met in full; larger ones go on in tiles
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
    twos = buckets.join(sizes.where("size = 2"), "bucket") \
        .select(F.least("low", "high").alias("a"), F.greatest("low", "high").alias("b")).distinct()
    comp = lambda name: known.select(F.col("node").alias(name), F.col("component").alias(f"c{name}"))
    apart = met.join(twos, ["a", "b"], "left_semi").join(comp("a"), "a", "left") \
        .join(comp("b"), "b", "left") \
        .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")) \
        .select("a", "b")
    wide = members.join(sizes.where("size > 2").select("bucket"), "bucket", "left_semi")
    further = 8
    while True:
        # Pairs that are possible but no links are refuted round by round: twice as many in each, so
        # that the number of rounds grows with the logarithm of what one tile holds.
        further *= 2
        found = materialize(map_groups(
            _tiles(wide, known, nodes, tested), "tile", "a bigint, b bigint, bucket bigint",
            lambda rows, further=further: compare_tile(rows, percent, further),
            shuffle_partitions(spark)), "found")
        # Components only grow, and refuted pairs stay refuted: a node whose possible pairs in a bucket
        # are all up for confirmation is done there.
        wide = materialize(
            found.where("b is null").select("bucket", F.col("a").alias("node")).distinct(), "open")
        pairs = found.where("b is not null").select("a", "b")
        pairs = pairs if apart is None else pairs.unionAll(apart)
        judged = confirm(pairs.distinct().join(tested, ["a", "b"], "left_anti"),
                         nodes, docs, words, percent)
        if judged.isEmpty():
            return known
        tested, apart = tested.unionAll(judged), None
        if not judged.where("link").isEmpty():
            known = materialize(components(tested.where("link").select("a", "b")), "components")


def group_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept of every row of `docs`: documents are linked if their
    sets of `words`-word shingles share `percent` per cent of their union."""
    docs = docs.select("doc_id", "text")
    sketches = materialize(sketch_documents(docs, words), "sketches")
    linked = link_nodes(docs, sketches, words, percent)
    rows = sketches.select("doc_id", "text_key", "n", "node", "twin") \
        .join(linked, "node", "left").select(
        "doc_id", "text_key", "n", "node", "twin", F.coalesce("component", "node").alias("group"))
    groups = rows.where("group is not null").groupBy("group", "node").agg(
        F.min("doc_id").alias("least"), F.min("twin").alias("one"), F.max("twin").alias("other"))
    checked = F.when(F.col("one") == F.col("other"), F.col("least")).otherwise(
        F.raise_error(F.lit("two shingle sets have one 64-bit hash")).cast("bigint"))
    groups = groups.select("group", checked.alias("least")) \
        .groupBy("group").agg(F.min("least").alias("least"))
    component = F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return rows.join(groups, "group", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"),
        (F.col("doc_id") == component).alias("kept"))


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with the row of least id of every group; all columns are kept. Rows without an id
    cannot be named as a copy of another and stay. Rows that repeat both id and text are one document
    that was given twice: they stay or go together, as other columns may tell them apart."""
    # only rows that go are joined; they are fewer than those that stay
    gone = group_documents(docs, words, percent).where("not kept") \
        .select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    return docs.join(
        gone, (docs["doc_id"] == gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_key"]),
        "left_anti").select(*docs.columns)
