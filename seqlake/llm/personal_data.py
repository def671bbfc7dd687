"""Personal data spans by weak supervision (operator 7).

Base spans (email, ip, card, phone) come from fixed patterns and checks and always stay. Further
candidates are long mixed strings (`secret`) and digit groups that fail every base check
(`number`). Regex, gazetteer and context labelers vote +1, 0 or -1 on each candidate, base spans
included. Votes are counted per pattern of votes in Spark; there are at most 3 ** len(LABELERS)
patterns, so the counts fit the driver whatever the corpus. Expectation-maximisation over the
counts estimates how often each labeler is right, and the resulting soft labels train a logistic
span classifier over votes and shape. Candidates that it accepts are added where they overlap no
base span.

Defined results: null and empty texts have no spans; each row is treated alone, repeated ids
included; without candidates nothing is added; an empty table gives an empty result. Offsets are
code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlake.llm.rows import map_rows, ship_package

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "number")
ANY = re.compile(r"[0-9@]")
LOCAL_CHARS = frozenset(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: The base patterns; fixed values. A digit run is tried at its start only, since an address that
#: fails there fails at each later digit too: no quadratic scan of long runs.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MIXED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+")
HEX = re.compile(r"[0-9A-Fa-f]{32,}")
SECRET_WORDS = re.compile(
    r"\b(token|secret|password|passwd|pwd|api[ _-]?key|access[ _-]?key|key|auth|bearer|"
    r"credential)\W{0,6}\Z", re.I)
PERSON_WORDS = re.compile(
    r"\b(phone|tel|call|mobile|fax|card|visa|account|iban|ssn|passport|mail|email|contact|"
    r"address|ip|host)\W{0,6}\Z", re.I)
DOMAINS = re.compile(r"\.(com|org|net|edu|gov|info|io|de|fr|es|uk|eu)\Z", re.I)
CONTEXT = 32
#: Pseudo-counts of right and wrong opinions of a labeler, and its least reliability.
PRIOR, LEAST = (8.0, 2.0), 0.6

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            out.append(("email", *m.span()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def _addresses(text: str) -> list[Span]:
    small = lambda part: len(part := part.lstrip("0")) <= 3 and int(part or 0) <= 255
    return [("ip", *m.span()) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and digit groups of plausible length that fail their check."""
    if not ANY.search(text):
        return [], []
    found, failed = _emails(text) + _addresses(text), []
    for kind, pattern, low, high in (("card", CARD, 14, 19), ("phone", PHONE, 10, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high:
                good = kind == "phone" or luhn(digits)
                (found if good else failed).append((kind if good else "number", *m.span()))
    return sorted(found, key=_place), failed


def _place(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def _overlaps(spans: list[Span]):
    taken = sorted((s, e) for _, s, e in spans)
    starts = [s for s, _ in taken]
    ends = list(accumulate((e for _, e in taken), max))

    def hit(start: int, end: int) -> bool:
        i = bisect_left(starts, end)
        return i > 0 and ends[i - 1] > start
    return hit


def candidates(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and further candidates that overlap none of them or each other."""
    if not text:
        return [], []
    base, failed = base_spans(text)
    if not base and not failed and not ANY.search(text):
        return [], []
    hit = _overlaps(base)
    more = [("secret", *m.span()) for m in MIXED.finditer(text)
            if any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0])]
    more = [s for s in more if not hit(s[1], s[2])]
    hit_secret = _overlaps(base + more)
    return base, sorted(more + [s for s in failed if not hit_secret(s[1], s[2])], key=_place)


# --- labelers: each votes +1 (personal or secret), -1 (harmless) or 0 (no opinion) ------------

def by_shape(kind: str, value: str, before: str, after: str) -> int:
    return 1 if kind in BASE_KINDS or HEX.fullmatch(value) else 0


def by_checksum(kind: str, value: str, before: str, after: str) -> int:
    return {"card": 1, "ip": 1, "number": -1}.get(kind, 0)


def by_secret_words(kind: str, value: str, before: str, after: str) -> int:
    return int(bool(SECRET_WORDS.search(before)))


def by_person_words(kind: str, value: str, before: str, after: str) -> int:
    if kind == "email":
        return 1 if DOMAINS.search(value) else 0
    return int(bool(PERSON_WORDS.search(before)))


def by_assignment(kind: str, value: str, before: str, after: str) -> int:
    left = before.rstrip("\"' ")
    return 1 if left.endswith(("=", ":")) else 0


def by_mixture(kind: str, value: str, before: str, after: str) -> int:
    """Random strings change between letters and digits often; names and codes rarely do."""
    if kind != "secret":
        return 0
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(value, value[1:]))
    return 1 if changes * 5 >= len(value) else -1 if changes * 16 < len(value) else 0


def by_neighbours(kind: str, value: str, before: str, after: str) -> int:
    glued = before[-1:].isalnum() or after[:1].isalnum()
    return -1 if glued else 0


LABELERS = (by_shape, by_checksum, by_secret_words, by_person_words, by_assignment, by_mixture,
            by_neighbours)


def votes(text: str, span: Span) -> str:
    """One character per labeler: + 0 -."""
    kind, start, end = span
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + 1]
    args = kind, text[start:end], before, after
    return "".join("-0+"[label(*args) + 1] for label in LABELERS)


def features(pattern: str) -> np.ndarray:
    """Classifier input: a constant, each labeler's vote and each labeler's opinion."""
    vote = np.array(["-0+".index(c) - 1 for c in pattern], float)
    return np.concatenate(([1.0], vote, vote != 0))


@dataclass
class SpanModel:
    weights: np.ndarray
    reliability: np.ndarray  # per labeler: share of its opinions that agree with the consensus

    def accepts(self, pattern: str) -> bool:
        return float(features(pattern) @ self.weights) > 0


def estimate(patterns: list[str], counts: list[int], rounds: int = 50) -> tuple:
    """Soft labels of vote patterns and reliabilities of the labelers, by EM.

    A labeler that has an opinion is right with its own probability. PRIOR says how often it is
    expected to be right, and no estimate may fall below LEAST: without that the classes could
    trade places. Having no opinion says nothing."""
    vote = np.array([["-0+".index(c) - 1 for c in p] for p in patterns], float)
    n = np.array(counts, float)
    opinion = vote != 0
    right = np.full(vote.shape[1], PRIOR[0] / sum(PRIOR))
    for _ in range(rounds):
        soft = 1 / (1 + np.exp(-vote @ np.log(right / (1 - right))))
        agree = np.where(vote > 0, soft[:, None], 1 - soft[:, None]) * opinion * n[:, None]
        share = (agree.sum(0) + PRIOR[0]) / ((opinion * n[:, None]).sum(0) + sum(PRIOR))
        right = np.clip(share, LEAST, 1 - 1e-3)
    return soft, right


def train(patterns: list[str], counts: list[int]) -> SpanModel:
    if not patterns:
        return SpanModel(np.zeros(1 + 2 * len(LABELERS)), np.full(len(LABELERS), 0.5))
    soft, reliability = estimate(patterns, counts)
    x = np.array([features(p) for p in patterns])
    n = np.array(counts, float) / sum(counts) * 1000 + 1  # rare patterns count a little
    w = np.zeros(x.shape[1])
    for _ in range(50):  # iteratively reweighted least squares with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (soft - p)) - 0.01 * w
        w += np.linalg.solve((x * (n * p * (1 - p) + 1e-6)[:, None]).T @ x
                             + 0.01 * np.eye(len(w)), slope)
    return SpanModel(w, reliability)


def fit_model(docs: DataFrame) -> SpanModel:
    def start():
        def step(text):
            seen = Counter(votes(t, s) for t in text if t
                           for part in candidates(t) for s in part)
            return list(seen), list(seen.values())
        return step

    counted = map_rows(docs.select("text"), "pattern string, n bigint", start) \
        .groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    return train([r["pattern"] for r in counted], [r["n"] for r in counted])


def all_spans(text: str | None, model: SpanModel) -> tuple[list[Span], list[Span]]:
    base, more = candidates(text)
    return base, [s for s in more if model.accepts(votes(text, s))]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=_place))


def find_spans(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit_model(docs))

    def start():
        own = shared.value

        def step(doc_id, text):
            found = [all_spans(t, own) for t in text]
            counts = [[sum(s[0] == kind for s in base) for base, _ in found]
                      for kind in BASE_KINDS]
            digest = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            return doc_id, *counts, digest, [joined(base + more) for base, more in found]
        return step

    return map_rows(
        docs.select("doc_id", "text"),
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string", start)


def redact(text: str | None, model: SpanModel) -> str | None:
    """Each run of overlapping spans becomes the kind of its first span in brackets."""
    if not text:
        return text
    base, more = all_spans(text, model)
    out, at, covered = [], 0, -1
    for kind, start, end in sorted(base + more, key=_place):
        if start >= covered:
            out += [text[at:start] if start > at else "", f"[{kind.upper()}]"]
        covered = max(covered, end)
        at = max(at, end)
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """`docs` with spans replaced in `text` and `n_chars` brought up to date; other columns and
    all rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit_model(docs))

    @F.pandas_udf("string")
    def cleaned(texts):
        own = shared.value
        return pd.Series([redact(t, own) for t in texts], index=texts.index, dtype=object)

    ship_package(docs.sparkSession)
    return docs.withColumn("text", cleaned.asNondeterministic()("text")) \
        .withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("bigint"))
                    .otherwise(F.col("n_chars"))).select(*docs.columns)
