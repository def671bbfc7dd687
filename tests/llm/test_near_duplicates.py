import random
import re

import numpy as np
import pytest

from seqlake.llm import near_duplicates as nd
from seqlake.llm.components import components
from seqlake.llm.rows import table
from seqlake.llm.shingles import shingle_set


def sets_of(texts, words):
    out = []
    for t in texts:
        w = [x for x in re.split(rb"[\x20\x09-\x0d]+", (t or "").encode().lower()) if x]
        out.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words
                   else {tuple(w)} if w else set())
    return out


def brute(rows, words, percent=80):
    """(doc_id, n_shingles, component_id) per row, from all pairs."""
    sets, root = sets_of([t for _, t in rows], words), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def check(docs, rows, words):
    got = nd.group_documents(docs, words).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) \
        == brute(rows, words)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("words", [2, 5])
def test_whole_table(spark, sf_dir, words):
    docs = table(spark, sf_dir, "documents")
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()], words)


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_around_the_limit(documents, monkeypatch):
    """Copies whose similarities lie on both sides of 0.8, so that groups hold several components
    and go through tiles of several blocks."""
    monkeypatch.setattr(nd, "TILE_NODES", 16)
    rng = random.Random(11)
    rows = []
    for base in range(3):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([30, 120]))]
        for _ in range(45):
            rows.append((len(rows), edited(rng, words, rng.randrange(len(words) // 7))))
    rows += [(500 + i, t) for i, t in enumerate(
        [None, "", " \n", "one", "ONE", "one two", "one  two\t", "a b c", "a b c", "a b c d"])]
    check(documents(rows), rows, 2)


def test_repeated_ids_and_nulls(documents):
    long = " ".join(f"w{i}" for i in range(40))
    docs = documents([(5, long), (5, "x y z"), (2, long), (7, None), (None, long), (None, "q r s")])
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"])
           for r in nd.group_documents(docs, 2).collect()}
    assert got == {(5, 39): (2, False), (5, 2): (5, True), (2, 39): (2, True), (7, 0): (7, True),
                   (None, 39): (2, None), (None, 2): (None, None)}
    kept = nd.keep_one_of_each(docs, 2)
    assert kept.columns == docs.columns
    rest = kept.collect()
    assert {(r["doc_id"], r["text"]) for r in rest if r["doc_id"] is not None} \
        == {(2, long), (5, "x y z"), (7, None)}
    assert sum(r["doc_id"] is None for r in rest) == 2
    assert nd.group_documents(documents([]), 2).collect() == []


def test_estimates():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    a = shingle_set(" ".join(words), 2)
    for times in (0, 5, 20):
        b = shingle_set(edited(rng, words, times), 2)
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        read = lambda s: np.frombuffer(nd.odd_sketch(nd.signature(s)), np.uint64)
        assert abs(nd.sketch_similarity(read(a), read(b)) - truth) < 0.15


@pytest.mark.parametrize("links", [[], [(1, 1)], [(1, 2)], [(5, 4), (4, 3), (3, 2), (9, 8), (8, 9)]])
def test_components(spark, links):
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    want = {x: min(g) for g in ([{1, 2}] if links == [(1, 2)] else [{2, 3, 4, 5}, {8, 9}]
                                if len(links) > 1 else []) for x in g}
    assert dict(map(tuple, got)) == want


def test_long_chain(spark):
    chain = spark.range(300).selectExpr("id * 7 % 301 AS a", "(id + 1) * 7 % 301 AS b")
    assert {r["component"] for r in components(chain).collect()} == {0}


def test_rows_that_repeat_id_and_text_stay_or_go_together(spark, documents):
    text = "one two three four five six seven"
    rows = [(2, text), (2, text), (5, text), (7, "quite another text of some length here"), (1, text), (1, text)]
    kept = nd.keep_one_of_each(documents(rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 1, 7]


def test_settled_buckets_are_not_compared_again(documents, monkeypatch):
    """A round takes up the buckets that had possible pairs in the round before, and no others."""
    taken, tiles = [], nd._tiles

    def watched(members, known, nodes, tested):
        taken.append({r["bucket"] for r in members.select("bucket").distinct().collect()})
        return tiles(members, known, nodes, tested)

    monkeypatch.setattr(nd, "_tiles", watched)
    rng = random.Random(3)
    rows = []
    for base in range(6):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        rows += [(len(rows) + i, edited(rng, words, rng.randrange(9))) for i in range(12)]
    check(documents(rows), rows, 2)
    assert len(taken) > 1 and all(b < a for a, b in zip(taken, taken[1:]))


def tile_row(node, words, left=True):
    hashes = shingle_set(" ".join(words), 2)
    return {"bucket": 9, "node": node, "component": node, "n": len(hashes),
            "bitmap": nd.parity(hashes), "refuted": None, "left": left}


def test_a_tile_names_the_nodes_that_wait():
    words = [f"w{i}" for i in range(80)]
    alike = [tile_row(i, [*words[:-1], f"x{i}"]) for i in range(5)]
    other = tile_row(7, [f"y{i}" for i in range(80)])
    told = list(nd.compare_tile([*alike, other], 80))
    pairs, waiting = [r for r in told if r[1] is not None], [r for r in told if r[1] is None]
    assert len(pairs) == 4 and sorted(waiting) == [(i, None, 9) for i in range(1, 5)]
    # all pairs are up for confirmation
    assert [r for r in nd.compare_tile([*alike, other], 80, 10) if r[1] is None] == []
