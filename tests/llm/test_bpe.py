import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seqlake.llm import bpe
from seqlake.llm.rows import table
from seqlake.llm.vocabulary import BYTE_BPE

PIECES = ["<|endoftext|>", " the", "'ll", " of", ". ", ", ", "..", "\n", "\n\n", "  ", "\t", "\xa0",
          "　", "\x1c", "\x1f", "é", "ñ", "٣", "½", "一", "😀", "́", "_", "a", "B", "1", "!!", "\x00"]


@pytest.fixture(scope="module")
def codec():
    return bpe.BpeCodec(open(BYTE_BPE, "rb").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def library_ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PIECES)).map("".join)))
def test_ids_are_the_library_s_and_come_back(codec, library, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library_ids(library, text)
    assert codec.decode(ids) == library.decode(library_ids(library, text), skip_special_tokens=False)


@pytest.mark.parametrize("text", ["ab" * 4000, "the" * 700 + "\n" + "Q" * 300, "é" * 500, " " * 900])
def test_long_words(codec, library, text):
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == library_ids(library, text)


def test_both_merges_agree(codec):
    word = list(("thereupon" * 30).encode())
    ids = [codec.byte_ids[b] for b in word]
    assert codec.merge_short(ids.copy()) == codec.merge_long(ids.copy())


def test_invalid_bytes_decode_like_the_library(codec, library):
    ids = library_ids(library, "é")
    halves = [codec.byte_ids[0xC3], codec.byte_ids[0x28]]
    for some in (ids, halves):
        assert codec.decode(np.array(some, "<u4").tobytes()) == library.decode(some)


def test_rows(spark, documents, library):
    docs = documents([(1, None), (1, None), (None, "a b"), (2, ""), (3, "a b"), (3, "a  b")])
    got = sorted(map(tuple, bpe.token_digests(docs).collect()), key=str)
    none = hashlib.sha256(b"").hexdigest()

    def row(doc_id, text):
        ids = np.array(library_ids(library, text), "<u4").tobytes()
        return doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), \
            hashlib.sha256(text.encode()).hexdigest()

    want = [(1, 0, none, none), (1, 0, none, none), row(None, "a b"), (2, 0, none, none),
            row(3, "a b"), row(3, "a  b")]
    assert got == sorted(want, key=str)
    assert bpe.token_digests(docs.limit(0)).collect() == []


def test_whole_table(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in bpe.token_digests(docs).collect():
        ids = library_ids(library, text[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()
