import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seqlake.llm import decontaminate as dc
from seqlake.llm.rows import table


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=20), st.lists(st.sampled_from("abcde"), max_size=30))
def test_longest_common_subsequences(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    places = dc.lcs_places(a, b)
    assert dc.lcs_length(a, b) == best[-1][-1] == len(places)
    assert all(a[i] == b[j] for i, j in places)
    assert places == sorted(places)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["Word", " ", "É", "_", "9", "—", "\xa0", "́", "İ", "ß", ",", "x\n", "字", "٣", "😀"])).map("".join))
def test_hashes_follow_the_words(text):
    found = dc.words_of(text)
    hashes = dc.hashes_of(text).tolist()
    assert len(hashes) == len(found)
    assert hashes == [int(dc.hashes_of(w)[0]) for w in found]


def words(rng, n, tag="w"):
    return [f"{tag}{rng.randrange(400)}" for _ in range(n)]


@pytest.fixture
def benchmark(spark):
    def build(items):
        return spark.createDataFrame([(*i, "noise") for i in items],
                                     "item_id bigint, text string, doc_id string")
    return build


def test_kinds_of_leaks(documents, benchmark):
    rng = random.Random(2)
    item = words(rng, 40, "q")
    long_item = words(rng, 300, "r")
    prose = lambda n: " ".join(words(rng, n))
    reworded = [w if i % 4 else "other" for i, w in enumerate(item)]  # 3 of 4 words, answer kept
    no_answer = item[:28] + words(rng, 12)
    scattered = [x for w in item for x in (w, *words(rng, 9))]
    rows = [
        (1, f"{prose(300)} {' '.join(item)} {prose(200)}"),
        (2, f"{prose(63)}\n{', '.join(item).upper()}! {prose(10)}"),
        (3, " ".join(item)), (4, f"{prose(90)} {' '.join(reworded)} {prose(90)}"),
        (5, f"{prose(90)} {' '.join(no_answer)} {prose(90)}"),
        (6, " ".join(scattered)), (7, prose(5000)), (8, None), (9, ""),
        (10, f"{prose(50)} {' '.join(long_item[100:200])} {prose(40)}"),
        (11, f"{prose(9)} tiny item here {prose(9)}"), (12, "here tiny item"),
        (13, f"{' '.join(item)} x {' '.join(long_item)}"), (1, prose(50)), (None, " ".join(item)),
    ]
    items = [(100, " ".join(item)), (200, " ".join(long_item)), (300, "Tiny item, here."),
             (400, None), (500, ""), (600, " ".join(item)), (None, "w1 w2 w3")]
    got = dc.judge(documents(rows), benchmark(items)).collect()
    found = sorted(((r["doc_id"], r["items"]) for r in got if r["contaminated"]), key=str)
    assert found == sorted([
        (1, [100, 600]), (2, [100, 600]), (3, [100, 600]), (4, [100, 600]), (10, [200]), (11, [300]),
        (13, [100, 200, 600]), (None, [100, 600])], key=str)
    assert len(got) == len(rows)
    assert all(r["items"] == [] and r["score"] == 0 for r in got if not r["contaminated"])


def test_blocks_of_items_do_not_change_the_result(documents, benchmark, monkeypatch):
    rng = random.Random(3)
    items = [(i, " ".join(words(rng, 30, f"i{i}x"))) for i in range(12)]
    rows = [(i, f"{' '.join(words(rng, 100))} {t}") for i, t in items[:6]] \
        + [(50, " ".join(words(rng, 500)))]
    whole = sorted(map(str, dc.judge(documents(rows), benchmark(items)).collect()))
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 5)
    assert sorted(map(str, dc.judge(documents(rows), benchmark(items)).collect())) == whole
    assert sum("contaminated=True" in r for r in whole) == 6


def test_empty_tables(documents, benchmark):
    item = " ".join(f"w{i}" for i in range(30))
    assert dc.judge(documents([]), benchmark([(1, item)])).collect() == []
    assert [r["contaminated"] for r in dc.judge(documents([(1, item)]), benchmark([])).collect()] \
        == [False]


def test_whole_table_against_brute_force(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    passages = [(r["item_id"], " ".join(dc.words_of(r["text"]))) for r in items.collect()]
    want = {}
    for r in docs.collect():
        text = f" {' '.join(dc.words_of(r['text']))} "
        want[r["doc_id"]] = sorted(i for i, p in passages if f" {p} " in text)
    got = {r["doc_id"]: r["items"] for r in dc.judge(docs, items).collect()}
    assert got == want and any(want.values())
    left = dc.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {d for d, found in want.items() if not found}


def test_leaks_without_their_rarest_words(documents, benchmark):
    rng = random.Random(5)
    items, rows = [], []
    for i in range(20):
        common, rare = words(rng, 33), [f"rare{i}x{j}" for j in range(7)]
        item = common[:]
        for j, w in enumerate(rare):
            item.insert(5 * j, w)
        items.append((i, " ".join(item)))
        rows.append((i, " ".join([*words(rng, 70), *[f"new{j}" if w in rare else w for j, w in
                                                     enumerate(item)], *words(rng, 70)])))
    rows += [(100 + i, " ".join(words(rng, 300))) for i in range(100)]
    got = {r["doc_id"]: r["items"] for r in dc.judge(documents(rows), benchmark(items)).collect()}
    assert got == {d: [d] if d < 100 else [] for d, _ in rows}


@pytest.mark.parametrize("kept", [0.6, 0.8])
def test_no_window_that_the_words_confirm_is_dropped(kept):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    prose = lambda n: rng.choices(vocabulary, weights, k=n)
    items = [(i, " ".join(prose(rng.randrange(1, 140)))) for i in range(60)]
    frequency = {w: 1000 // (i + 1) for i, w in enumerate(vocabulary)}
    block = dc.Passages.of(items, frequency, 1000)
    confirmed = 0
    for number, passage in enumerate(block.words):
        changed = set(rng.sample(range(len(passage)), int((1 - kept) * len(passage))))
        text = [*prose(70), *["-new" if i in changed else w for i, w in enumerate(passage)]]
        found = {k: (at, term) for k, at, term in dc.windows(" ".join(text), block)}
        text = dc.words_of(" ".join(text))
        for k in range(max(1, -(-len(text) // dc.PASSAGE) - 1)):
            if dc.leak_score(passage, text[k * dc.PASSAGE :][: 2 * dc.PASSAGE]):
                confirmed += 1
                at, term = found[k]
                score = dc.leak_score(block.order[number], term.tolist(), at.tolist())
                assert score == dc.leak_score(passage, text[k * dc.PASSAGE :][: 2 * dc.PASSAGE])
                held = dc.np.zeros((1, len(block.idf)), bool)
                held[0, term] = True
                zero = dc.np.zeros(1, int)
                assert block.holding(held, zero, zero + number).all()
                shared = dc.np.isin(block.terms[number], term)
                assert (block.idf[dc.np.array(block.terms[number])[shared]] ** 2).sum() \
                    >= block.least[number] - 1e-6
    assert confirmed > 30


def test_the_bound_on_common_weights_holds_for_any_basis():
    rng = dc.np.random.default_rng(4)
    idf = rng.uniform(0.5, 9, 80)
    terms = [sorted(rng.choice(80, rng.integers(1, 40), replace=False).tolist()) for _ in range(40)]
    for rank in (1, 5, 40, 80):
        basis, _ = dc.np.linalg.qr(rng.standard_normal((80, rank)))
        latent = dc._latent(terms, idf, basis)
        bound = dc.common_weight(latent, latent)
        for r in range(40):
            common = [sum(idf[t] ** 2 for t in {*terms[r]} & {*u}) for u in terms]
            assert all(bound[r] >= common)


def test_no_copy_is_lost_in_a_block_of_many_items(documents, benchmark):
    rng = random.Random(6)
    prose = lambda n: " ".join(f"w{rng.randrange(20_000)}" for _ in range(n))
    items = [(i, prose(rng.randrange(15, 61))) for i in range(2000)]
    rows = [(i, f"{prose(rng.randrange(200))} {t} {prose(rng.randrange(200))}") for i, t in items]
    got = dc.judge(documents(rows), benchmark(items)).collect()
    assert [r["doc_id"] for r in got if r["doc_id"] not in r["items"]] == []


def brute_leaks(text, passages):
    """Items of the passages that some window of the text holds, by words alone."""
    found, all_words = {}, dc.words_of(text)
    for k in range(max(1, -(-len(all_words) // dc.PASSAGE) - 1)):
        window = all_words[k * dc.PASSAGE :][: 2 * dc.PASSAGE]
        for item, passage in passages:
            score = dc.leak_score(passage, window)
            if score:
                found[item] = max(score, found.get(item, 0.0))
    return found


def test_whole_result_against_longest_common_subsequences_of_all_windows(documents, benchmark):
    """Paraphrases of every strength: words replaced, left out, added and moved."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(250)]
    prose = lambda n: rng.choices(vocabulary, [1 / (i + 1) for i in range(250)], k=n)
    items = [(i, " ".join(prose(rng.randrange(1, 150)))) for i in range(25)]
    rows = []
    for n in range(120):
        passage = dc.words_of(items[n % 25][1])
        strength = rng.choice([0, 0.1, 0.25, 0.35, 0.45])
        changed = [x for w in passage for x in (
            [] if rng.random() < strength / 2 else
            [rng.choice(vocabulary) if rng.random() < strength else w]
            + prose(rng.random() < strength / 2))]
        rows.append((n, " ".join([*prose(rng.randrange(150)), *changed, *prose(rng.randrange(150))])))
    block = dc.Passages.of(items, {}, 1)
    passages = list(zip(block.item, block.words))
    got = {r["doc_id"]: (r["items"], r["score"]) for r in
           dc.judge(documents(rows), benchmark(items)).collect()}
    for n, text in rows:
        want = brute_leaks(text, passages)
        assert got[n][0] == sorted(want), n
        assert abs(got[n][1] - max(want.values(), default=0.0)) < 1e-12
    assert 30 < sum(bool(found) for found, _ in got.values())


def test_very_long_text_and_repeated_rows(documents, benchmark):
    rng = random.Random(12)
    item = " ".join(words(rng, 40, "q"))
    long = " ".join(words(rng, 150_000))
    rows = [(1, long), (2, f"{long} {item} {long}"), (2, f"{long} {item} {long}"), (3, item), (3, "clean")]
    got = dc.judge(documents(rows), benchmark([(9, item)])).collect()
    assert sorted((r["doc_id"], r["contaminated"]) for r in got) == [
        (1, False), (2, True), (2, True), (3, False), (3, True)]
