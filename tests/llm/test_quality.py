import random
import re

from seqlake.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_measures(spark, documents):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a a a a", "a b a b a b", "x\n\nx\n x\nx",
             "é😀 # <|> $%&*\x0bz\x0cy\xa0w\u2028v", "a b c d a b c"]
    texts += ["".join(rng.choice("ab \n#é\t") for _ in range(rng.randint(0, 80))) for _ in range(150)]
    rows = [(i % 150, t) for i, t in enumerate(texts)]
    got = quality.measure(documents(rows)).collect()
    want = sorted((i, *brute(t)) for i, t in rows)
    assert sorted((r["doc_id"], *(r[m] for m in quality.MEASURES)) for r in got) == want
    assert quality.judge(documents([])).collect() == []


def text(seed, bad=False):
    rng = random.Random(seed)
    words = [rng.choice("abcdefgh") * rng.randint(2, 9) + str(rng.random()) for _ in range(80)]
    return " ".join(w[:7] + ("###" if bad else "") for w in words)


def test_host_verdicts(spark):
    rows = [(i, text(i, bad=i % 10 > 0), "bad") for i in range(60)]
    rows += [(100 + i, text(i, bad=i == 0), "good") for i in range(60)]
    rows += [(200, text(7, bad=True), "tiny"), (300, "few words", "good"), (301, text(1), None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string") \
        .selectExpr("*", "1 AS bad", "2 AS failed")
    kept = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.judge(docs).collect()}
    assert [kept[i][1] for i in range(60)] == [i % 10 == 0 for i in range(60)]
    assert all(kept[100 + i] == (False, True) for i in range(60))
    assert kept[300] == (True, False) and kept[301] == (False, True)
