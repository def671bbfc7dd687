"""Byte-level BPE encoding and decoding (operator 4).

Method: a word is held as a contiguous array of part boundaries' ids beside an array of the merge
ranks of adjacent parts. The minimum rank is found by a scan, its boundary is deleted and the two
neighbouring ranks are refreshed, until no rank is left. Scans are quadratic in the word, so words
above LONG_WORD parts (rare runs without white space) find their minimum in a heap instead; the
order of merges, and so the result, is the same.

Defined results: null and empty texts have no ids; strings of added tokens inside a text become
those tokens; every input row gives one output row, repeated ids included; an empty table gives an
empty result. Only `doc_id` and `text` are read, so further columns cannot clash.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlake.llm.rows import map_rows, per_worker
from seqlake.llm.vocabulary import BYTE_BPE, PieceEncoder, broadcast_file

LONG_WORD = 192
NO_RANK = 1 << 60
#: White space of the Unicode property; fixed values.
SPACE = r"\t-\r \x85\xa0  -     　"
#: The byte-level word pattern; fixed value.
WORD = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: visible Latin-1 characters stand for themselves, all
    other bytes follow from code point 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


class BpeCodec:
    def __init__(self, tokenizer_json: bytes) -> None:
        spec = json.loads(tokenizer_json)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbols = byte_symbols()
        raw = {s: bytes([b]) for b, s in enumerate(symbols)}
        self.byte_ids = [vocab[s] for s in symbols]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: b"".join(raw[c] for c in token) for token, i in vocab.items()}
        self.bytes_of |= {i: token.encode() for token, i in added.items()}
        # (left id, right id) in one integer -> (rank, merged id) in one integer
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left] << 20 | vocab[right]] = rank << 20 | vocab[left + right]
        self.added = {t: i.to_bytes(4, "little") for t, i in added.items()}
        longest_first = sorted(added, key=len, reverse=True)
        self.added_pattern = regex.compile("|".join(map(regex.escape, longest_first)))
        self.words: dict[str, bytes] = {}
        self.pieces = PieceEncoder(self.encode_whole, pattern_word=self.encode_word, added=added)

    def merge_short(self, ids: list[int]) -> list[int]:
        pair = self.merges.get
        ranks = [pair(a << 20 | b, NO_RANK) for a, b in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            at = ranks.index(least)
            ids[at] = least & 0xFFFFF
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = pair(ids[at - 1] << 20 | ids[at], NO_RANK)
            if at < len(ranks):
                ranks[at] = pair(ids[at] << 20 | ids[at + 1], NO_RANK)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        pair, n = self.merges.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i) for i in range(n - 1) if (m := pair(ids[i] << 20 | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            merge, i = heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or pair(ids[i] << 20 | ids[j]) != merge:
                continue
            ids[i], ids[j] = merge & 0xFFFFF, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    m = pair(ids[left] << 20 | ids[after[left]])
                    if m is not None:
                        heappush(heap, (m, left))
        return [i for i in ids if i >= 0]

    def encode_word(self, word: str) -> bytes:
        ids = [self.byte_ids[b] for b in word.encode()]
        ids = self.merge_short(ids) if len(ids) <= LONG_WORD else self.merge_long(ids)
        return np.array(ids, "<u4").tobytes()

    def encode_words(self, text: str) -> bytes:
        known, out = self.words, []
        for word in WORD.findall(text):
            ids = known.get(word)
            if ids is None:
                ids = self.encode_word(word)
                if len(word) <= 64:
                    if len(known) > 50_000:
                        known.clear()
                    known[word] = ids
            out.append(ids)
        return b"".join(out)

    def encode_whole(self, text: str) -> bytes:
        out, at = [], 0
        if self.added:
            for m in self.added_pattern.finditer(text):
                out += [self.encode_words(text[at : m.start()]), self.added[m.group()]]
                at = m.end()
        return b"".join([*out, self.encode_words(text[at:] if at else text)])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.pieces.ids(text)

    def decode(self, ids: bytes | None) -> str:
        numbers = np.frombuffer(ids or b"", "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, numbers)).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit integers) for every row of `docs`."""
    file = broadcast_file(docs.sparkSession, path)

    def start():
        codec = per_worker(("bpe", path), lambda: BpeCodec(file.value))
        return lambda doc_id, text: (doc_id, [codec.encode(t) for t in text])

    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, ids binary", start)


def decode_documents(encoded: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """doc_id, ids, text: the text that the ids stand for."""
    file = broadcast_file(encoded.sparkSession, path)

    def start():
        codec = per_worker(("bpe", path), lambda: BpeCodec(file.value))
        return lambda doc_id, ids: (doc_id, ids, [codec.decode(i) for i in ids])

    return map_rows(
        encoded.select("doc_id", "ids"), "doc_id bigint, ids binary, text string", start)


def token_digests(docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, through both directions."""
    decoded = decode_documents(encode_documents(docs, path), path)
    return decoded.select(
        "doc_id", F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"))
