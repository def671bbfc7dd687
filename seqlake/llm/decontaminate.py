"""Benchmark decontamination by latent semantic retrieval (operator 3).

Benchmark items are taken in blocks of bounded size, each against all documents:

1. Items become passages of at most PASSAGE words. Document frequencies of their words are counted
   over all documents; they give the weights and the order of rarity.
2. Documents become overlapping windows of two passages' length, so that every passage lies in one
   window as a whole. Step 5 accepts nothing below LIKELY of a passage's n words (short passages: all
   of them), say `need`. So a window with a leak has at least k of the passage's n - need + k rarest
   words, for any k: the others are only need - k. With k = need / KEY_PART, windows for which this
   holds for no passage are dropped; no leak is lost. Words are compared by 64-bit hashes here.
3. A randomised SVD of the TF-IDF rows of these windows and of the block's passages: every task
   sketches its rows (A'A times a random matrix), sums are built in Spark, and only matrices of terms
   x rank reach the driver.
4. Candidates are found by cosine: batches of window vectors times the passages' vectors, for the
   pairs with k of the passage's rarest words (see 2). The latent product and the product of the lengths that the latent space leaves out bound what both have in
   common from above; pairs whose bound is below the least weight that `need` words of the passage
   can have are dropped. The bound holds for any rank, so no leak is lost to it. Pairs whose window
   has fewer than `need` words of the passage, in whatever order, are dropped as well.
5. A candidate is confirmed on the words in order, which a window's row carries: longest common
   subsequence of passage and window, and how far its words are spread. From SURE of the passage on
   it is a leak; from LIKELY on (paraphrases) only if the answer, the passage's last quarter, is
   found as well. Passages shorter than SHORT words must occur word for word.

Words are runs of word characters in lower case, so changes of case, punctuation or white space do
not hide a leak.

Defined results: null and empty texts are clean; null and empty items are passed over; equal texts
get equal results, rows with equal ids are judged by their own text; equal items are all reported;
empty tables give clean or empty results. A text is split as a whole, which takes some 60 bytes a byte
of it while it is split.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlake.llm.rows import map_arrow, map_groups, map_rows, shuffle_partitions
from seqlake.llm.shingles import U, run_hashes
from seqlake.session import materialize

WORD = re.compile(r"\w+")
#: A block of items ends at either; its terms are at most its words.
BLOCK_ITEMS, BLOCK_WORDS = 2_000, 100_000
PASSAGE = 64
RANK, OVERSAMPLING = 128, 16
SURE, LIKELY, ANSWER = 0.8, 0.6, 0.6
SHORT = 13
#: A leak has so many words of a passage; one in KEY_PART of them is asked among the rarest ones.
KEY_PART = 5
#: Slack for rounding in cosines, which are sums of single-precision products.
ROUNDING = 1e-4
#: Up to so many keys of texts (8 bytes each) are broadcast.
BROADCAST_KEYS = 1_000_000
#: Up to so many cells (4 bytes each) sparse rows are spread out for a matrix product, which is faster.
DENSE_CELLS = 8_000_000
NOT_ASCII_NOR_WORD = re.compile(r"[^\w\x00-\x7f]")
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(128, 256), *b"_abcdefghijklmnopqrstuvwxyz0123456789"]] = True


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def hashes_of(text: str | None) -> np.ndarray:
    """A hash per word of `words_of`, in order, without a Python step per word."""
    if not text:
        return np.zeros(0, U)
    text = text.lower()
    if not text.isascii():
        text = NOT_ASCII_NOR_WORD.sub(" ", text)
    return run_hashes(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), IN_WORD)


@dataclass
class Vocabulary:
    """Words by the order of their hashes."""

    hashes: np.ndarray
    words: list[str]
    seen: np.ndarray  # whether some word's hash has these upper bits

    @classmethod
    def of(cls, words: set[str]) -> Vocabulary:
        # a word alone has exactly one hash
        found = sorted((int(hashes_of(w)[0]), w) for w in words)
        hashes = np.array([h for h, _ in found], U)
        seen = np.zeros(1 << 20, bool)
        seen[hashes >> U(44)] = True
        return cls(hashes, [w for _, w in found], seen)

    def places(self, text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Places in the text of known words, their numbers, and how many words the text has."""
        hashes = hashes_of(text)
        at = np.flatnonzero(self.seen[hashes >> U(44)])
        held = hashes[at]
        number = np.searchsorted(self.hashes, held)
        number[number == len(self.hashes)] = 0
        same = self.hashes[number] == held if len(at) else np.zeros(0, bool)
        return at[same], number[same], len(hashes)


def least_weight(weights: np.ndarray, counts: np.ndarray, need: int) -> float:
    """No choice of words that stand for `need` places of a passage weighs less than this."""
    order = np.argsort(weights / counts, kind="stable")
    places = np.minimum(np.cumsum(counts[order]), need)
    return float((np.diff(places, prepend=0) * weights[order] / counts[order]).sum())


@dataclass
class Passages:
    """The passages of one block of items and their terms."""

    item: list[int]
    words: list[list[str]]
    order: list[list[int]]  # of each passage: the terms of its words, one after another
    terms: list[list[int]]
    counts: list[list[int]]  # how often each passage has each of its terms
    needed: list[int]  # of each passage: so many of its words does a leak have
    vocabulary: Vocabulary
    idf: np.ndarray
    least: np.ndarray  # of each passage: least squared weights that it shares with a leak
    hits: np.ndarray  # of each passage: k, so many of its rarest words does a leak have
    fewest: int  # places of such words in a text with a leak
    rare: np.ndarray  # of each term: whether it is among the rarest words of some passage
    first: np.ndarray  # of each term: where its postings begin, and the end of the last
    passage: np.ndarray  # postings: passages that have the term among their rarest words
    count: np.ndarray  # postings: how often

    @classmethod
    def of(cls, items: list[tuple[int, str]], frequency: dict[str, int], n_docs: int) -> Passages:
        item, words = [], []
        for item_id, text in items:
            all_words = words_of(text)
            parts = -(-len(all_words) // PASSAGE)
            for k in range(parts):  # parts of equal length
                words.append(all_words[k * len(all_words) // parts :
                                       (k + 1) * len(all_words) // parts])
                item.append(item_id)
        vocabulary = Vocabulary.of({x for w in words for x in w})
        number = {w: i for i, w in enumerate(vocabulary.words)}
        df = np.array([max(1, frequency.get(w, 0)) for w in vocabulary.words], float)
        idf = np.log1p(max(n_docs, 1) / df)
        terms, times, needed, least, hits, postings = [], [], [], [], [], []
        for p, w in enumerate(words):
            n = len(w)
            need = n if n < SHORT else math.ceil(LIKELY * n - 1e-9)
            found, counts = np.unique([number[x] for x in w], return_counts=True)
            terms.append(found.tolist())
            times.append(counts.tolist())
            needed.append(need)
            least.append(least_weight(idf[found] ** 2, counts, need))
            hits.append(-(-need // KEY_PART))
            rarest = sorted(w, key=lambda x: (frequency.get(x, 0), x))[: n - need + hits[-1]]
            postings += [(number[x], p, c) for x, c in Counter(rarest).items()]
        table = np.array(sorted(postings), np.int64).reshape(-1, 3)
        first = np.searchsorted(table[:, 0], np.arange(len(idf) + 1))
        fewest = max(1, min(-(-h // max(c.values())) for h, c in zip(hits, map(Counter, words))))
        order = [[number[x] for x in w] for w in words]
        return cls(item, words, order, terms, times, needed, vocabulary, idf, np.array(least), np.array(hits), fewest,
                   np.diff(first) > 0, first, table[:, 1], table[:, 2])

    def holding(self, held: np.ndarray, r: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Of pairs (r, p): whether window r, whose terms are row r of `held`, has as many words of
        passage p as a leak has."""
        out = np.zeros(len(r), bool)
        for passage in np.unique(p):
            of = np.flatnonzero(p == passage)
            found = held[r[of]][:, self.terms[passage]] @ np.array(self.counts[passage])
            out[of] = found >= self.needed[passage]
        return out

    def near(self, row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, passage) wherever the row's distinct terms have enough of the passage's rarest
        words."""
        begin = self.first[term]
        size = self.first[term + 1] - begin
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        pair = np.repeat(row, size) * len(self.hits) + self.passage[at]
        order = np.argsort(pair)
        pair = pair[order]
        start = np.flatnonzero(np.diff(pair, prepend=-1))
        found = np.add.reduceat(self.count[at[order]], start) if len(pair) else pair
        row, passage = np.divmod(pair[start], len(self.hits))
        enough = found >= self.hits[passage]
        return row[enough], passage[enough]


def windows(text: str | None, passages: Passages) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(number, places, terms) of the windows that can hold a passage: the known words, in order,
    and their places in the window."""
    place, term, n_words = passages.vocabulary.places(text)
    rare = passages.rare[term]
    if np.count_nonzero(rare) < passages.fewest:
        return []
    last = max(0, -(-n_words // PASSAGE) - 2)
    n_terms = len(passages.idf)
    cell, twice = place[rare] // PASSAGE, np.tile(term[rare], 2)
    both = np.concatenate((np.minimum(cell, last), np.clip(cell - 1, 0, last)))
    both = np.sort(both * n_terms + twice)
    near, _ = passages.near(*np.divmod(both[np.diff(both, prepend=-1) > 0], n_terms))
    numbers = np.unique(near)
    begin = np.searchsorted(place, numbers * PASSAGE)
    end = np.searchsorted(place, (numbers + 2) * PASSAGE)
    return [(int(n), place[i:j] - n * PASSAGE, term[i:j])
            for n, i, j in zip(numbers.tolist(), begin.tolist(), end.tolist())]


def _flat(terms: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and distinct terms of lists of terms, ascending."""
    flat = np.concatenate([np.array(t, np.int64) for t in terms])
    row = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    width = int(flat.max(initial=0)) + 1
    return np.divmod(np.unique(row * width + flat), width)


def _rows(terms: list[list[int]], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, unit-length TF-IDF weights and row numbers of sparse rows."""
    row, flat = _flat(terms)
    weight = idf[flat]
    norm = np.sqrt(np.bincount(row, weight**2, len(terms)))
    return flat, weight / norm[row], row


def _spread(rows, n: int, n_terms: int) -> np.ndarray | None:
    """Sparse rows as a matrix, if that has no more than DENSE_CELLS cells."""
    if n * n_terms > DENSE_CELLS:
        return None
    term, weight, row = rows
    out = np.zeros((n, n_terms), np.float32)
    out[row, term] = weight
    return out


def _times(rows, dense: np.ndarray, n: int) -> np.ndarray:
    """Sparse rows x dense matrix, in single precision."""
    dense = dense.astype(np.float32, copy=False)
    spread = _spread(rows, n, len(dense))
    if spread is not None:
        return spread @ dense
    term, weight, row = rows
    starts = np.searchsorted(row, np.arange(n))
    part = dense[term]
    part *= weight.astype(np.float32)[:, None]
    return np.add.reduceat(part, starts, axis=0)


def _transposed(rows, dense: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Transposed sparse rows x dense matrix: the terms that occur, and their sums."""
    spread = _spread(rows, len(dense), n_terms)
    if spread is not None:
        return np.arange(n_terms), spread.T @ dense
    term, weight, row = rows
    order = np.argsort(term, kind="stable")
    found, starts = np.unique(term[order], return_index=True)
    return found, np.add.reduceat((dense[row] * weight[:, None])[order], starts, axis=0)


def _sum_vectors(df: DataFrame, start, size: int) -> np.ndarray:
    """Sum, per key below `size`, of the vectors that tasks hold; `start()` returns a function
    from a batch's term lists to (distinct keys, vectors). Vectors are added up per task before the
    shuffle, in a matrix of `size` rows."""
    def per_task(batches):
        step, total = start(), None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                keys, vectors = step(batch.slice(at, 512).column(0).to_pylist())
                if total is None:
                    total = np.zeros((size, vectors.shape[1]))
                total[keys] += vectors
        held = np.flatnonzero(total.any(1)) if total is not None else []
        for at in range(0, len(held), 256):
            part = held[at : at + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array([total[k].tobytes() for k in part], pa.binary())],
                names=["key", "vector"])

    partial = map_arrow(df.select("terms"), per_task, "key bigint, vector binary")
    spark = df.sparkSession
    # a block's terms x its width as bytes of doubles: BLOCK_WORDS x 144 x 8 bytes at most
    summed = map_groups(
        partial, "key", "key bigint, vector binary",
        lambda rows: [(rows[0]["key"],
                       np.sum([np.frombuffer(r["vector"]) for r in rows], axis=0).tobytes())],
        min(64, shuffle_partitions(spark))).collect()
    width = len(summed[0]["vector"]) // 8 if summed else 0
    out = np.zeros((size, width))
    for r in summed:
        out[r["key"]] = np.frombuffer(r["vector"])
    return out


def latent_basis(rows: DataFrame, passages: Passages) -> np.ndarray:
    """Terms x rank: leading right singular vectors of the TF-IDF rows in `rows` (column terms) and
    of the passages, whose rows together weigh as much as all windows."""
    n_terms = len(passages.idf)
    width = min(RANK + OVERSAMPLING, n_terms)
    omega = np.random.default_rng(3).standard_normal((n_terms, width))
    spark = rows.sparkSession
    idf = passages.idf
    own = _rows(passages.terms, idf)
    share = max(1, rows.count()) / len(passages.terms)

    def with_own(total: np.ndarray, found: np.ndarray, sums: np.ndarray) -> np.ndarray:
        total = total if total.size else np.zeros((len(total), sums.shape[1]))
        total[found] += share * sums
        return total

    shared = spark.sparkContext.broadcast((idf, omega.astype(np.float32)))

    def sketch():
        weights, random = shared.value

        def step(terms):
            sparse = _rows(terms, weights)
            return _transposed(sparse, _times(sparse, random, len(terms)), len(weights))
        return step

    ranged = with_own(_sum_vectors(rows, sketch, n_terms),
                      *_transposed(own, _times(own, omega, len(passages.terms)), n_terms))
    q, _ = np.linalg.qr(ranged)
    shared_q = spark.sparkContext.broadcast((idf, q.astype(np.float32)))

    def gram():
        weights, basis = shared_q.value

        def step(terms):
            b = _times(_rows(terms, weights), basis, len(terms))
            return np.arange(b.shape[1]), b.T @ b
        return step

    mine = _times(own, q, len(passages.terms))
    core = with_own(_sum_vectors(rows, gram, width), np.arange(width), mine.T @ mine)
    _, vectors = np.linalg.eigh(core)
    return q @ vectors[:, ::-1][:, :RANK]


def _latent(terms: list[list[int]], idf: np.ndarray, basis: np.ndarray):
    """Latent vectors of unit-length rows, the lengths that the basis leaves out, and the rows' own
    lengths."""
    sparse = _rows(terms, idf)
    vectors = _times(sparse, basis, len(terms))
    rest = np.sqrt(np.maximum(1 - (vectors**2).sum(1), 0))
    return vectors, rest, np.sqrt(np.bincount(sparse[2], idf[sparse[0]] ** 2, len(terms)))


def common_weight(rows, targets) -> np.ndarray:
    """Rows x targets: upper bounds of the squared weights of the terms that both have in common, for
    any orthonormal basis."""
    cosine = rows[0] @ targets[0].T + np.outer(rows[1], targets[1])
    return (cosine + ROUNDING) * np.outer(rows[2], targets[2])


def lcs_length(a: list[str], b: list[str]) -> int:
    """Longest common subsequence, one bit per word of `a`."""
    at: dict[str, int] = {}
    for i, word in enumerate(a):
        at[word] = at.get(word, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for word in b:
        hit = row & at.get(word, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def lcs_places(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places (in a, in b) of a longest common subsequence that ends as early in `b` as it can."""
    n = len(b)
    table = [[0] * (n + 1)]
    for x in a:
        last, row = table[-1], [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[j], last[j + 1]))
        table.append(row)
    i, j, out = len(a), table[-1].index(table[-1][-1]), []
    while i and j:
        if a[i - 1] == b[j - 1] and table[i][j] == table[i - 1][j - 1] + 1:
            out.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif table[i - 1][j] >= table[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def leak_score(passage: list, window: list, at: list[int] | None = None) -> float:
    """Share of the passage that the window has in order and close together, 0 if it is no leak.
    `at` are the places of the window's words where other words in between are left out."""
    n = len(passage)
    at = range(len(window)) if at is None else at
    if n < SHORT:
        return float(any(
            window[i] == passage[0] and window[i : i + n] == passage and at[i + n - 1] - at[i] == n - 1
            for i in range(len(window) - n + 1)))
    if lcs_length(passage, window) < LIKELY * n:
        return 0.0
    places = [(i, at[j]) for i, j in lcs_places(passage, window)]
    # words far from the others are chance finds: keep the densest stretch of twice the length
    best: list[tuple[int, int]] = []
    left = 0
    for right in range(len(places)):
        while places[right][1] - places[left][1] >= 2 * n:
            left += 1
        if right - left + 1 > len(best):
            best = places[left : right + 1]
    share = len(best) / n
    if share >= SURE:
        return share
    answer = n - n // 4
    found = sum(i >= answer for i, _ in best)
    return share if share >= LIKELY and found >= ANSWER * (n - answer) else 0.0


def _frequencies(docs: DataFrame, words: set[str]) -> dict[str, int]:
    """Documents that have each of `words`, over all documents."""
    vocabulary = Vocabulary.of(words)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def start():
        known = shared.value

        def step(text):
            total = np.zeros(len(known.hashes), np.int64)
            for t in text:
                seen = np.zeros(len(total), bool)
                seen[known.places(t)[1]] = True
                total += seen
            found = np.flatnonzero(total)
            return found, total[found]
        return step

    rows = map_rows(docs.select("text"), "word bigint, n bigint", start) \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {vocabulary.words[r["word"]]: r["n"] for r in rows}


def _leaks_of_block(docs: DataFrame, items: list[tuple[int, str]], n_docs: int) -> DataFrame | None:
    """key (hash of the text), item, score: confirmed leaks of one block of items."""
    spark = docs.sparkSession
    vocabulary = {w for _, text in items for w in words_of(text)}
    if not vocabulary:
        return None
    passages = Passages.of(items, _frequencies(docs, vocabulary), n_docs)
    shared = spark.sparkContext.broadcast(passages)

    def cut():
        block = shared.value

        def step(key, text):
            out: tuple[list, list, list] = ([], [], [])
            for k, t in zip(key, text):
                for _, places, terms in windows(t, block):
                    for column, value in zip(out, (k, places, terms)):
                        column.append(value)
            return out
        return step

    rows = materialize(
        map_rows(docs.select("key", "text"), "key bigint, places array<int>, terms array<int>", cut),
        "windows")
    basis = latent_basis(rows, passages)
    basis = basis.astype(np.float32)
    latent = spark.sparkContext.broadcast((basis, *_latent(passages.terms, passages.idf, basis)))

    def search():
        block, (directions, *targets) = shared.value, latent.value

        def step(key, places, terms):
            if not key:
                return [], [], []
            flat = _flat(terms)
            bound = common_weight(_latent(terms, block.idf, directions), targets)
            r, p = block.near(*flat)
            close = bound[r, p] >= block.least[p]
            r, p = r[close], p[close]
            held = np.zeros((len(terms), len(block.idf)), bool)
            held[flat] = True
            likely = block.holding(held, r, p)
            best: dict[tuple[int, int], float] = {}
            for i, j in zip(r[likely].tolist(), p[likely].tolist()):
                score = leak_score(block.order[j], terms[i], places[i])
                if score:
                    leak = key[i], block.item[j]
                    best[leak] = max(score, best.get(leak, 0.0))
            return [k for k, _ in best], [item for _, item in best], list(best.values())
        return step

    return map_rows(rows, "key bigint, item bigint, score double", search)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """key (xxhash64 of the text), items (sorted ids), score: one row per contaminated text."""
    spark = docs.sparkSession
    texts = docs.select(F.xxhash64("text").alias("key"), "text").where("text is not null")
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null")
    size = items.agg(F.count("*").alias("n"), F.coalesce(
        F.sum(F.size(F.split("text", r"\W+"))), F.lit(0)).alias("words")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ITEMS), -(-size["words"] // BLOCK_WORDS))
    n_docs = texts.count()
    found = spark.createDataFrame([], "key bigint, item bigint, score double")
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = [(r["item_id"], r["text"]) for r in chosen.orderBy("item_id", "text").collect()]
        leaks = _leaks_of_block(texts, rows, n_docs)
        found = found if leaks is None else found.unionAll(leaks)
    return materialize(found.groupBy("key").agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.max("score").alias("score")), "leaks")


def judge(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, items, score of every row of `docs`."""
    leaks = find_leaks(docs, benchmark)
    rows = docs.select("doc_id", F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("key"))
    return rows.join(leaks, "key", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the rows whose text holds a passage of the benchmark; all columns are kept."""
    leaks = find_leaks(docs, benchmark).select(F.col("key").alias("leak_key"))
    leaks = F.broadcast(leaks) if leaks.count() <= BROADCAST_KEYS else leaks
    key = F.when(docs["text"].isNotNull(), F.xxhash64(docs["text"]))
    return docs.join(leaks, key == leaks["leak_key"], "left_anti").select(*docs.columns)
