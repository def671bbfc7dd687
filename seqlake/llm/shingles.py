"""Sets of word shingles as 64-bit hashes, without a Python step per word.

Words are runs of `[^\\x20\\x09-\\x0D]` of the text with A-Z in lower case. A word's hash is a
polynomial of its bytes, read off prefix sums, and mixed; a shingle's hash combines its words in
order. A text with fewer words than a shingle is one shingle of all its words.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15
MIX_1, MIX_2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Powers:
    """Powers of BASE and of its inverse modulo 2**64, grown as longer texts come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << n.bit_length()
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, U)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * MIX_1
    h = (h ^ (h >> U(27))) * MIX_2
    return h ^ (h >> U(31))


def run_hashes(data: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Hashes of the maximal runs of bytes that `inside` (256 flags) holds for."""
    if not len(data):
        return np.zeros(0, U)
    held = np.concatenate(([False], inside[data], [False]))
    change = np.flatnonzero(held[1:] != held[:-1])
    starts, ends = change[::2], change[1::2]
    up, down = POWERS.upto(len(data))
    sums = np.concatenate((np.zeros(1, U), np.cumsum((data.astype(U) + U(1)) * up)))
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode("utf-8", "replace").lower(), np.uint8)
    return run_hashes(data, ~BLANK)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Distinct shingle hashes in ascending order; empty for a text without words."""
    h = word_hashes(text)
    if not len(h):
        return h
    size = min(words, len(h))
    n = len(h) - size + 1
    out = np.full(n, U(size))
    for j in range(size):
        out = mix(out * U(BASE) + h[j : j + n])
    return np.unique(out)
