"""Public tokenizer files, read once by the driver, and the split of a text into cacheable pieces.

A file is a few MB whatever the corpus, so its bytes are broadcast: executors need no local copy.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from pathlib import Path

import public_tokenizers
from pyspark import Broadcast
from pyspark.sql import SparkSession

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
#: Remembered pieces per Python worker by kind of cut, some 200 bytes each: bounds its memory (50 MB in
#: all), not what is encoded. Most texts consist of plain words.
WORD_ENTRIES, PROSE_ENTRIES, SPACED_ENTRIES = 120_000, 80_000, 50_000
#: Letters, and marks that are no letters, digits or white space, whose code points have long been assigned:
#: the same in every Unicode version.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f\u0400-\u0481\u048a-\u0527"
MARKS = r"!-/:-@\[-`{-~" + "\xa1-\xa9\xab\xac\xae-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7\u2010-\u2027\u2030-\u205e\u20ac"
#: The byte-level word pattern on these, ASCII digits, spaces and line breaks; other characters match nothing.
PLAIN_WORD = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[{MARKS}]+|[ \n]+(?![^ \n])|[ \n]+")
#: Cuts a text into pieces; a text that has it is encoded otherwise.
CUT = "\x1f"


def broadcast_file(spark: SparkSession, path: str = BYTE_BPE) -> Broadcast:
    return spark.sparkContext.broadcast(Path(path).read_bytes())


class Irregular(Exception):
    """The pieces of this cut cannot be encoded one by one."""


class Words(dict):
    """Ids of words, encoded when they are first looked up and remembered in two generations as in Memo:
    the dictionary itself is the young one."""

    def __init__(self, entries: int, encode: Callable[[str], bytes]) -> None:
        self.entries, self.encode = entries, encode
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= 64:
            if len(self) >= self.entries // 2:
                self.old = self.copy()
                self.clear()
            self[word] = ids
        return ids


class Memo:
    """Ids of pieces in two generations: when the young one is full it becomes the old one, so that
    frequent pieces survive. `check` raises Irregular for a piece that cannot stand alone."""

    def __init__(self, entries: int, check: Callable[[str], None],
                 encode_all: Callable[[list[str]], list[bytes]],
                 word: Callable[[str], bytes | None] | None = None) -> None:
        self.entries, self.check, self.encode_all, self.word = entries, check, encode_all, word
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece; those not remembered that are no words are encoded together."""
        found = list(map(self.young.get, pieces))
        if None not in found:
            return found
        missing = set(pieces).difference(self.young)
        fresh = {p: self.old[p] for p in missing if p in self.old}
        wanted = [p for p in missing if p not in fresh]
        if self.word:
            words = list(map(self.word, wanted))
            fresh.update((p, ids) for p, ids in zip(wanted, words) if ids is not None)
            wanted = [p for p, ids in zip(wanted, words) if ids is None]
        for piece in wanted:
            self.check(piece)
        if wanted:
            fresh.update(zip(wanted, self.encode_all(wanted)))
        short = {p: ids for p, ids in fresh.items() if len(p) <= 64}
        if len(self.young) + len(short) > self.entries // 2:
            self.old, self.young = self.young, {}
        if len(short) <= self.entries // 2:
            self.young.update(short)
        return [fresh[p] if ids is None else ids for p, ids in zip(pieces, found)]


def _prose(piece: str) -> None:
    if piece in (".", ",", "\n"):
        return
    core = piece[1:] if piece[:1] == " " else piece
    if not core or core[0].isspace() or not core[-1].isalnum():
        raise Irregular


def _spaced(piece: str) -> None:
    core = piece[1:] if piece[:1] == " " else piece
    if piece != "\n" and (not core or core[0].isspace() or core[-1].isspace()):
        raise Irregular


class PieceEncoder:
    """Encodes texts piece by piece (little-endian uint32 ids) with remembered pieces.

    A text of plain characters without added tokens is cut into the words of the byte-level pattern
    themselves. For others: the byte-level pattern keeps letters, digits, other marks and white space apart, and joins a
    single space to what follows it. So plain prose can be cut before spaces, around line breaks
    and before a full stop or comma that follows a letter or digit; other texts with single spaces
    and line breaks only at these. A cut that meets a piece it does not hold for is given up for
    the next one, and in the end the text is encoded whole.
    """

    def __init__(self, encode: Callable[[str], bytes],
                 encode_all: Callable[[list[str]], list[bytes]] | None = None,
                 word: Callable[[str], bytes | None] | None = None,
                 pattern_word: Callable[[str], bytes] | None = None, added: Iterable[str] = (),
                 entries: int = WORD_ENTRIES) -> None:
        """`encode_all` encodes pieces that passed a check, none of them blank, at once. `word` encodes a
        piece of letters behind at most one space, which passes every check, and gives None for others.
        `pattern_word` encodes a word of the byte-level pattern, where texts without one of the `added`
        tokens are cut by this pattern and nothing else; `entries` of these words are remembered."""
        self.encode = encode
        self.added = list(added)
        self.words = pattern_word and Words(entries, pattern_word)
        encode_all = encode_all or (lambda pieces: [encode(p) for p in pieces])
        self.prose = Memo(PROSE_ENTRIES, _prose, encode_all, word)
        self.spaced = Memo(SPACED_ENTRIES, _spaced, encode_all, word)

    def cut(self, text: str | None) -> tuple[Memo, list[str]] | None:
        """The memo and the pieces of the finest cut that the text may take."""
        if not text or CUT in text:
            return None
        spaced = text.replace(" ", CUT + " ").replace("\n", CUT + "\n" + CUT)
        if ".." in text or ",," in text or ".," in text or ",." in text:
            return self.spaced, spaced.split(CUT)
        prose = spaced.replace(",", CUT + ",").replace(".", CUT + ".")
        return self.prose, prose.split(CUT)

    def joined(self, text: str | None, cut: tuple[Memo, list[str]] | None) -> bytes:
        if cut is None:
            return self.encode(text) if text else b""
        memo, pieces = cut
        try:
            return b"".join(memo.ids(pieces))
        except Irregular:
            if memo is self.spaced:
                return self.encode(text)
        spaced = text.replace(" ", CUT + " ").replace("\n", CUT + "\n" + CUT)
        return self.joined(text, (self.spaced, spaced.split(CUT)))

    def ids(self, text: str | None) -> bytes:
        """Ids of a whole text; empty for null."""
        if text and self.words is not None:
            pieces = PLAIN_WORD.findall(text)
            if "".join(pieces) == text and not any(token in text for token in self.added):
                return b"".join(map(self.words.__getitem__, pieces))
        return self.joined(text, self.cut(text))
