import math
import random

import numpy as np
import pytest

from seqlake.llm import toxicity
from seqlake.llm.rows import table


def frames(spark, rows, labels):
    docs = spark.createDataFrame(
        [(i, t, "en", "src", 0.5, True) for i, t in rows],
        "doc_id bigint, text string, lang string, source string, score double, held_out boolean")
    marks = spark.createDataFrame(
        [(i, 1, x, "t") for i, x in labels], "doc_id bigint, quality int, toxic int, text string")
    return docs, marks


def corpus(n=400, seed=1):
    """Texts of random words; every fourth has insults whose forms vary, and is labelled so."""
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(2, 9))) for _ in range(600)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(20, 120))
        if i % 4 == 0:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(["Zorgk", "zwalb"]) + rng.choice(["en", "er", "üx", ""]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def crc_held_out(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_search_equals_a_scan_of_all_examples():
    rng = np.random.default_rng(4)
    n_terms, examples = 60, []
    for i in range(500):
        ids = np.sort(rng.choice(n_terms, rng.integers(1, 9), replace=False))
        w = rng.integers(1, 4, len(ids)).astype(float)
        examples.append((i, int(ids[0] < 10), ids, w / np.sqrt(w @ w)))
    index = toxicity.Index.of(examples, n_terms)
    by_id = {e[0]: e for e in examples}
    dense = np.zeros((500, n_terms))
    for place, i in enumerate(index.ids):
        dense[place, by_id[i][2]] = by_id[i][3]
    blocks_read = []
    for _ in range(200):
        ids = np.sort(rng.choice(n_terms, rng.integers(1, 6), replace=False))
        w = rng.random(len(ids)) + 0.1
        w /= np.sqrt(w @ w)
        without = int(rng.integers(500))
        scan = np.round(dense[:, ids] @ w, 12)
        scan[index.ids.index(without)] = 0
        best = np.lexsort((np.arange(500), -scan))[:15]
        best = best[scan[best] > 0]
        places, cosines, read = index.search(ids, w, 15, without)
        assert places.tolist() == best.tolist()
        assert np.allclose(cosines, scan[best], atol=1e-11)
        blocks_read.append(read)
    assert min(blocks_read) < len(index.weights)


def test_vectors_and_idf(spark):
    vectors = toxicity.Vectors(["ab ", "abcd", "abcde"])
    ids, tf = vectors.counts("ABCDE abcd ab, x abcdefg ab " + "q" * 70)
    # abcd and abcde begin three and two words; two words are no term
    assert dict(zip(ids.tolist(), tf.tolist())) == {0: 2, 1: 3, 2: 2, 3: 2}
    docs, _ = frames(spark, [(1, "ab ab x"), (2, None), (3, "abcdef"), (3, "abcdef")], [])
    rows, found = toxicity.document_frequencies(docs, ["ab ", "abcd", "abcde"])
    assert rows == 4 and found.tolist() == [1, 2, 2, 1]


def test_unseen_forms_are_found_and_clean_texts_left_alone(spark):
    rows, labels = corpus()
    docs, marks = frames(spark, rows, labels)
    got = {r["doc_id"]: r for r in toxicity.judge(docs, marks).collect()}
    assert len(got) == len(rows)
    assert all(r["held_out"] == crc_held_out(i) and 0 <= r["score"] <= 1 for i, r in got.items())
    wrong = [i for i, label in labels if got[i]["predicted"] != label]
    assert len(wrong) <= 4
    toxic = got[next(i for i, label in labels if label and got[i]["held_out"])]
    assert len(toxic["evidence"]) == toxicity.NEIGHBOURS
    cosines = [e["cosine"] for e in toxic["evidence"]]
    assert cosines == sorted(cosines, reverse=True) and 0 < cosines[-1] <= cosines[0] <= 1 + 1e-9


def test_held_out_labels_are_never_learned(spark):
    rows, labels = corpus(300, 2)
    docs, marks = frames(spark, rows, labels)
    flipped = [(i, 1 - x if crc_held_out(i) else x) for i, x in labels] + [(None, 1)]
    _, turned = frames(spark, rows, flipped)
    key = lambda r: r["doc_id"]
    score = lambda m: [(r["doc_id"], r["score"]) for r in sorted(
        toxicity.judge(docs, m).collect(), key=key)]
    assert score(marks) == score(turned)


def test_odd_rows(spark):
    rows, labels = corpus(200, 3)
    odd = [(None, "zorgk zwalb zorgken"), (900, None), (901, ""), (902, "123 .,"), (903, "zorgken " * 100_000),
           (904, "z" * 300_000), (0, rows[0][1]), (0, "another text")]
    docs, marks = frames(spark, rows + odd, labels + [(0, 1), (0, None), (1, 0), (None, 1)])
    got = toxicity.judge(docs, marks).collect()
    assert len(got) == len(rows) + len(odd)
    empty = {r["score"] for r in got if r["doc_id"] in (900, 901, 902)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert [r["predicted"] for r in got if r["doc_id"] == 903] == [1]
    assert [r["predicted"] for r in got if r["doc_id"] == 904] == [0]
    assert all(r["evidence"] == [] for r in got if r["doc_id"] in (900, 901, 902))


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1), (2, 1)], 1.0)])
def test_labels_that_tell_nothing_apart(spark, labels, score):
    labels = [(i, x) for i, x in labels if not crc_held_out(i)]
    docs, marks = frames(spark, [(1, "a b"), (2, None), (7, "c")], labels)
    got = toxicity.judge(docs, marks).collect()
    assert [(r["score"], r["predicted"]) for r in got] == [(score, int(score))] * 3
    assert toxicity.judge(docs.where("false"), marks).collect() == []


def test_scores_are_calibrated_and_accurate_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.judge(docs, labels).drop("evidence").join(
        labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    truth = np.array([r["toxic"] for r in scored])
    score = np.array([r["score"] for r in scored])
    found = score >= 0.5
    recall, precision = (found & (truth > 0)).sum() / truth.sum(), truth[found].mean()
    assert recall >= 0.85 and precision >= 0.9
    brier = ((score - truth) ** 2).mean()
    assert brier < 0.03 and math.isclose(score.mean(), truth.mean(), abs_tol=0.03)
