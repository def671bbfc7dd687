import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from seqlake.llm import repeats
from seqlake.llm.rows import table
from seqlake.llm.suffix_sort import suffix_array


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40))
def test_suffix_array(text):
    text = [*text, 0]
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_of_long_texts():
    rng = random.Random(1)
    for text in ([rng.randrange(1, 4) for _ in range(3000)], [1] * 5000, [1, 2] * 2000,
                 list(range(3000, 0, -1)), list(range(1, 3000))):
        text = [*text, 0]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i : i + 5001])
    assert suffix_array([]) == []


def brute(rows, length=repeats.LENGTH):
    """Rows in document order; every string that started before."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            piece = data[i : i + length]
            if piece in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc_id] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def found(docs):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for r in repeats.remove_repeats(docs).collect()}


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert found(docs) == want
    assert sum(v[1] for v in want.values()) > 0


def test_shifted_and_edited_pieces(documents):
    rng = random.Random(8)
    base = "".join(rng.choice("ab \0é") for _ in range(700))
    rows = []
    for i in range(90):
        a, n = rng.randrange(600), rng.randrange(60, 500)
        piece = list(base[a : a + n])
        for _ in range(rng.randrange(3)):
            piece[rng.randrange(len(piece))] = "X"
        rows.append((i, base[a : a + 99] + "".join(piece) + rng.choice(["", "ab" * 90, "z" * 250])))
    # lengths just below, at and above the limit; at the begin and end of texts
    rows += [(200 + i, base[300 : 300 + 50 + i]) for i in range(45)]
    assert found(documents(rows)) == brute(rows)


def test_overlaps_within_a_document(documents):
    rows = [(1, "a" * 100), (2, "b" * 101), (3, "c" * 1000), (4, "de" * 300), (5, "a" * 99), (6, ""),
            (7, None), (8, "f" * 99), (9, "f" * 99)]
    got = found(documents(rows))
    assert got == brute(rows)
    assert got[2][1] == 100 and got[1][1] == 0


def test_repeated_rows(documents):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdef") for _ in range(300))
    docs = documents([(2, text), (1, text), (1, text), (3, text[:99]), (None, text[:150] + "x")])
    rows = sorted((r["doc_id"] or 0, r["n_removed"]) for r in repeats.remove_repeats(docs).collect())
    # the row without an id comes first; equal rows of id 1 are one document
    assert rows == [(0, 0), (1, 150), (1, 150), (2, 300), (3, 0)]
    assert repeats.remove_repeats(documents([])).collect() == []


def test_long_document(documents):
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefghij ") for _ in range(300_000))
    rows = [(1, long), (2, long[1000:250_000] + "!" + long[:500])]
    got = found(documents(rows))
    assert got[1][1] == 0 and got[2][1:3] == (249_500, 2)
