import json
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seqlake.llm import simple8b, vocabulary
from seqlake.llm.bpe import BpeCodec
from seqlake.llm.rows import table
from seqlake.llm.vocabulary import BYTE_BPE

VALUES = st.one_of(st.integers(0, 1), st.integers(0, 70_000), st.integers(0, 2**64 - 1),
                   st.sampled_from([2**60 - 1, 2**60, 2**64 - 1]))


@settings(max_examples=200, deadline=None)
@given(st.lists(VALUES, max_size=300))
def test_round_trip(values):
    array = np.array(values, np.uint64)
    assert simple8b.unpack(simple8b.pack(array)).tolist() == values


def test_ranges_are_read_from_their_blocks():
    values = np.random.default_rng(1).integers(0, 50_257, 50_000).astype(np.uint64)
    values[::997] = 2**63
    payload = simple8b.pack(values)
    assert len(payload) < 2.6 * len(values)
    for first, last in ((0, 1), (0, 50_000), (12_345, 12_346), (49_999, 60_000), (7, 7), (3, 40_001)):
        assert simple8b.unpack(payload, first, last).tolist() == values[first:last].tolist()


def test_repeated_values_share_words():
    assert len(simple8b.pack(np.ones(6000, np.uint64))) < 8 * 130


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        simple8b.unpack(b"\0" * 24)


def expected(rows):
    library = Tokenizer.from_file(BYTE_BPE)
    at, out = 0, []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = simple8b.token_file_digests(docs).collect()
    assert sorted(map(tuple, got)) == expected(rows)


def test_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(simple8b, "RUN_DOCS", 2)  # several runs in a file
    rows = [(None, "first"), (1, ""), (2, None), (3, "x " * 5000), (4, "a"), (5, "b"), (6, "c d")]
    got = simple8b.token_file_digests(documents(rows[::-1])).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows)
    twice = simple8b.token_file_digests(documents([(1, "a"), (1, "a"), (1, "b")])).collect()
    assert sorted(r["start"] for r in twice) == [0, 2, 4]
    assert simple8b.token_file_digests(documents([])).collect() == []


def test_words_go_straight_to_the_model():
    file = Path(BYTE_BPE).read_bytes()
    library, word = Tokenizer.from_str(file.decode()), simple8b.library_encoder(file).prose.word
    for text in ["a", " a", "Wörterbuch", " élan", " словарь", "unhappily" * 9, " ǅ"]:
        assert word(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert [word(t) for t in ["", " ", "  a", "don't", "a1", "\n", "a b", "語", "é", "ª"]] == [None] * 10
    # a tokenizer that changes letters, or has a token of letters, sees every text whole
    for change in ({"normalizer": {"type": "Lowercase"}},
                   {"added_tokens": [{"id": 50256, "content": "abc", "single_word": False, "lstrip": False,
                                      "rstrip": False, "normalized": False, "special": True}]}):
        other = json.dumps({**json.loads(file), **change})
        encoder, whole = simple8b.library_encoder(other.encode()), Tokenizer.from_str(other)
        assert encoder.prose.word is None
        ids = whole.encode("ABC abc xabcx", add_special_tokens=False).ids
        assert encoder.ids("ABC abc xabcx") == np.array(ids, "<u4").tobytes()


PLAIN = ["ab", "Straße", "слово", " ", "\n", ".", "&&&", "'", "'s", "'ll", "12", "’", "—", "\xd7", "<|endoftext|>"]
OTHER = ["\t", "\xa0", "語", "\xbd", "́", " ", "\x1f", "\xaa"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PLAIN + OTHER), max_size=14).map("".join))
def test_plain_words(text):
    if "encoder" not in KEPT:
        file = Path(BYTE_BPE).read_bytes()
        KEPT.update(encoder=simple8b.library_encoder(file), library=Tokenizer.from_str(file.decode()),
                    codec=BpeCodec(file))
    want = np.array(KEPT["library"].encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert KEPT["encoder"].ids(text) == want == KEPT["codec"].encode(text)


KEPT: dict = {}


def test_plain_texts_are_cut_into_words_only(monkeypatch):
    file = Path(BYTE_BPE).read_bytes()
    library, text = Tokenizer.from_str(file.decode()), "A Straße&&& of 12, don't\n\n\"so\"  b..  "
    want = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    for encoder in (simple8b.library_encoder(file), BpeCodec(file).pieces):
        monkeypatch.setattr(encoder, "joined", lambda *_: b"cut otherwise")
        assert encoder.ids(text) == encoder.ids(text) == want
        assert encoder.ids(text + "\t") == encoder.ids("a<|endoftext|>") == b"cut otherwise"


def test_remembered_words_are_bounded():
    asked = []
    words = vocabulary.Words(8, lambda word: asked.append(word) or word.encode())
    for i in [*range(20), *range(16, 20)]:
        assert words["a"] == b"a" and words[str(i)] == b"%d" % i
        assert len(words) <= 4 and len(words.old) <= 4
    assert words["x" * 65] == b"x" * 65 and "x" * 65 not in words
    assert asked == ["a", *map(str, range(20)), "x" * 65]


def test_plain_classes():
    for of, inside in ((vocabulary.LETTERS, r"\p{L}"), (vocabulary.MARKS, r"[^\s\p{L}\p{N}]")):
        listed = "".join(filter(re.compile(f"[{of}]").match, map(chr, range(0x3000))))
        assert listed and regex.fullmatch(f"{inside}+", listed)
