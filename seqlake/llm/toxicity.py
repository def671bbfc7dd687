"""Toxicity by nearest labelled examples over block-max inverted indexes (operator 13).

Terms of a text are its words and their beginnings of 4 to 6 letters, which inflected forms share. Of
the terms of the labelled texts, those whose presence depends on the label (chi-square) are index terms;
all other words of a text together are one more. A text's vector holds (1 + ln tf) * idf by index term,
with document frequencies counted over the whole corpus, scaled to length 1.

The examples are dealt to blocks of BLOCK. Each index term has, per block, its weights in the block's
examples and their greatest. A query adds up its terms' greatest weights, which bounds the cosine of
every example of a block, takes blocks in descending order of that bound, and stops at the first
whose bound is below the k-th best cosine found, so the neighbours are those of a full scan. The share
of toxic neighbours, weighted by cosine, becomes a probability by logistic calibration on the votes
that labelled texts receive without their own example. The neighbours are the evidence.

Bounds: learning takes LEARN_ROWS labelled texts of each label, those with the smallest digests of their
ids, and INDEX_ROWS of each become examples. The index has at most 2 * INDEX_ROWS examples of TERMS + 1
weights (100 MB at worst, some MB as a rule) and goes to the tasks with their code. Document frequencies
cover all rows, whole texts are read, and nothing is shuffled by document.

Defined results: null and empty texts and texts without letters have no neighbours and score the
calibrated share of toxic texts; so does every text if no labelled one is toxic or all are, and 0 with
no labels. Rows of an id count on their own; an id that several texts or labels have is learned with
one of its texts and as toxic if any label says so. Rows with a null id are never learned from. Equal
labelled texts are learned once. Of equal cosines the example placed first wins. Words above 64
letters count as words that are no index term.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlake.llm.rows import map_arrow, map_rows
from seqlake.session import materialize

LEARN_ROWS, INDEX_ROWS, TERMS = 8_000, 1_500, 4_095
NEIGHBOURS, BLOCK = 15, 128
#: Least chi-square of an index term, and the least labelled texts that have it.
CHI_SQUARE, LEAST_TEXTS = 24.0, 3
BEGINNINGS, LONGEST = (4, 5, 6), 64
HEAD = min(BEGINNINGS)
#: Distinct entries that a task counts or remembers before it starts anew.
HELD = 250_000
SLACK = 1e-9
WORD = re.compile("[A-Za-z\x80-\U0010ffff]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def terms_of(word: str) -> list[str]:
    """The word itself, marked by a blank, and its beginnings."""
    if len(word) > LONGEST:
        return []
    return [word + " ", *(word[:n] for n in BEGINNINGS if len(word) >= n)]


class Vectors:
    """Counts index terms of texts. Only words that begin like an index term are looked at one by
    one; what such a word holds is remembered in bounded memory."""

    def __init__(self, terms: list[str]) -> None:
        self.place = {t: i for i, t in enumerate(terms)}
        self.rest = len(terms)
        self.heads = {t.rstrip(" ")[:HEAD] for t in terms}
        self.known: dict[str, list[int]] = {}

    def of_word(self, word: str) -> list[int]:
        found = self.known.get(word)
        if found is None:
            found = [self.place[t] for t in terms_of(word) if t in self.place]
            if len(self.known) >= HELD:
                self.known.clear()
            self.known[word] = found
        return found

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Index terms of a text in ascending order, and their frequencies."""
        all_words, heads = words(text), self.heads
        total: dict[int, int] = {}
        others = len(all_words)
        alike = [w for w in set(all_words) if w[:HEAD] in heads and len(w) <= LONGEST]
        times = Counter(all_words) if len(alike) > 4 else {w: all_words.count(w) for w in alike}
        for word in alike:
            found = self.of_word(word)
            if found:
                n = times[word]
                others -= n
                for i in found:
                    total[i] = total.get(i, 0) + n
        if others:
            total[self.rest] = others
        ids = np.array(sorted(total), np.int64)
        return ids, np.array([total[i] for i in ids.tolist()], np.float64)

    def weigh(self, text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, tf = self.counts(text)
        w = (1 + np.log(tf)) * idf[ids]
        return ids, w / math.sqrt(w @ w) if len(w) else w


@dataclass
class Index:
    """Examples in blocks: per block the terms it has, their weights (terms x BLOCK), and per
    term and block the greatest weight."""

    ids: list
    toxic: np.ndarray
    greatest: np.ndarray  # terms x blocks
    rows: list[np.ndarray]  # of a block: term -> row of its weights; the last row is zero
    weights: list[np.ndarray]

    @classmethod
    def of(cls, examples: list[tuple], n_terms: int) -> Index:
        """`examples` are (id, toxic, term ids, weights); like ones are placed together."""
        def heaviest(example):
            return (example[1], *sorted(zip(-example[3], example[2]))[:2])

        placed = sorted(examples, key=heaviest)
        blocks = [placed[at : at + BLOCK] for at in range(0, len(placed), BLOCK)]
        greatest = np.zeros((n_terms, len(blocks)))
        rows, weights = [], []
        for b, block in enumerate(blocks):
            held = np.unique(np.concatenate([e[2] for e in block]))
            row = np.full(n_terms, len(held), np.int32)
            row[held] = np.arange(len(held))
            table = np.zeros((len(held) + 1, BLOCK))
            for slot, example in enumerate(block):
                table[row[example[2]], slot] = example[3]
            greatest[held, b] = table[:-1].max(1)
            rows.append(row)
            weights.append(table)
        return cls([e[0] for e in placed], np.array([e[1] for e in placed], np.float64),
                   greatest, rows, weights)

    def search(self, terms: np.ndarray, w: np.ndarray, k: int, without=None) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and cosines of the k nearest examples with a common term, best first, and the
        number of blocks that were read. Examples of the id `without` are passed over."""
        bound = w @ self.greatest[terms]
        places, cosines, read = np.zeros(0, np.int64), np.zeros(0), 0
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or (len(cosines) == k and bound[b] < cosines[-1] - SLACK):
                break
            near = w @ self.weights[b][self.rows[b][terms]]
            read += 1
            at = np.flatnonzero(near > (cosines[-1] - SLACK if len(cosines) == k else 0))
            if not len(at):
                continue
            if without is not None:
                at = at[[self.ids[b * BLOCK + i] != without for i in at.tolist()]]
            places = np.concatenate((places, at + b * BLOCK))
            # rounded, so that equal cosines are equal whatever the order of their sums
            cosines = np.concatenate((cosines, np.round(near[at], 12)))
            best = np.lexsort((places, -cosines))[:k]
            places, cosines = places[best], cosines[best]
        return places, cosines, read


@dataclass
class Model:
    terms: list[str]
    idf: np.ndarray
    index: Index
    share: float  # toxic ones among all labelled rows to learn from
    slope: float = 1.0
    offset: float = 0.0

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        """Log odds of toxic among the neighbours, weighted by cosine; one pseudo-neighbour each way."""
        for_it = cosines @ self.index.toxic[places] if len(places) else 0.0
        return math.log((for_it + 0.5) / (cosines.sum() - for_it + 0.5))

    def score(self, places: np.ndarray, cosines: np.ndarray) -> float:
        if not len(places):
            return self.share
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * self.vote(places, cosines) + self.offset))))

    def finder(self) -> Callable:
        """Neighbours of a text; equal vectors are looked up once."""
        vectors, known = Vectors(self.terms), {}

        def find(text: str | None, without=None) -> tuple[np.ndarray, np.ndarray]:
            terms, w = vectors.weigh(text, self.idf)
            if not len(terms):
                return np.zeros(0, np.int64), np.zeros(0)
            key = None if without is not None or len(terms) > 8 else (terms.tobytes(), w.tobytes())
            if key in known:
                return known[key]
            found = self.index.search(terms, w, NEIGHBOURS, without)[:2]
            if key is not None:
                if len(known) >= 10_000:
                    known.clear()
                known[key] = found
            return found
        return find

    def calibrate(self, votes: np.ndarray, toxic: np.ndarray) -> None:
        """Logistic regression of the label on the vote, labels weighted to their true shares."""
        weight = np.where(toxic > 0, self.share / max(toxic.mean(), 1e-9),
                          (1 - self.share) / max(1 - toxic.mean(), 1e-9))
        x, beta = np.stack((votes, np.ones(len(votes))), 1), np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            # a mild pull to (1, 0) keeps separable votes finite
            gradient = x.T @ (weight * (p - toxic)) + 0.1 * (beta - [1.0, 0.0])
            curve = x.T @ (x * (weight * p * (1 - p))[:, None]) + 0.1 * np.eye(2)
            step = np.linalg.solve(curve, gradient)
            beta = beta - step
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.offset = max(float(beta[0]), 0.0), float(beta[1])


def held_out() -> F.Column:
    """Rows that no label is learned from: crc32 of the id's text divisible by 5."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learned_texts(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float | None]:
    """doc_id, toxic and text of the bounded sample, and the toxic share of all rows to learn from."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")) \
        .where(F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id") \
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    counted = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    digest = F.xxhash64(F.col("doc_id").cast("string"), F.lit(13))
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(digest, "doc_id").limit(LEARN_ROWS)
        chosen = part if chosen is None else chosen.unionAll(part)
    # at most 2 * LEARN_ROWS ids; the join leaves one text of an id, and one row of a text
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .join(F.broadcast(chosen), "doc_id")
    code = F.xxhash64("text")
    one = texts.groupBy("doc_id").agg(
        F.min_by(F.struct("text", "toxic"), F.struct(code, F.length("text"))).alias("row")) \
        .select("doc_id", "row.*")
    distinct = one.groupBy(code.alias("code"), F.length("text").alias("size")).agg(
        F.min_by(F.struct("doc_id", "text", "toxic"), "doc_id").alias("row")).select("row.*")
    return distinct, counted["toxic"] / counted["n"] if counted["n"] else None


def count_labelled_terms(learned: DataFrame) -> DataFrame:
    """term, texts, toxic (toxic texts with it) in parts to be added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            terms = list(held[0] | held[1])
            out = pa.RecordBatch.from_arrays([
                pa.array(terms, pa.string()),
                pa.array([held[0][t] + held[1][t] for t in terms], pa.int64()),
                pa.array([held[1][t] for t in terms], pa.int64())], ["term", "texts", "toxic"])
            held[0].clear()
            held[1].clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                held[toxic].update({t for w in words(text.as_py()) for t in terms_of(w)})
                if len(held[0]) + len(held[1]) > HELD:
                    yield flush()
        yield flush()

    return map_arrow(learned.select("text", "toxic"), run, "term string, texts bigint, toxic bigint")


def index_terms(learned: DataFrame) -> list[str]:
    """The terms whose presence depends most on the label."""
    sizes = learned.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = sizes["n"], sizes["toxic"] or 0
    if not 0 < toxic < n:
        return []
    counted = count_labelled_terms(learned).groupBy("term").agg(
        F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic")).where(F.col("texts") >= LEAST_TEXTS)
    a, b = F.col("toxic").cast("double"), F.col("texts") - F.col("toxic")
    c, d = F.lit(toxic) - a, F.lit(n - toxic) - b
    chi = F.lit(n) * (a * d - b * c) * (a * d - b * c) / (
        F.lit(float(toxic)) * (n - toxic) * F.col("texts") * F.greatest(n - F.col("texts"), F.lit(1)))
    rows = counted.withColumn("chi", chi).where(F.col("chi") >= CHI_SQUARE) \
        .orderBy(F.desc("chi"), "term").limit(TERMS).collect()
    return sorted(r["term"] for r in rows)


def document_frequencies(docs: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    """Rows of the corpus, and how many of them have each index term (the last: any other word)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, found, rows = Vectors(terms), np.zeros(len(terms) + 1, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column("text"):
                found[vectors.counts(text.as_py())[0]] += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *at.tolist()], pa.int32()), pa.array([rows, *found[at].tolist()])],
            ["term", "docs"])

    counted = map_arrow(docs.select("text"), run, "term int, docs bigint") \
        .groupBy("term").agg(F.sum("docs").alias("docs")).collect()  # TERMS + 2 rows
    out, rows = np.zeros(len(terms) + 1, np.int64), 0
    for r in counted:
        if r["term"] < 0:
            rows = r["docs"]
        else:
            out[r["term"]] = r["docs"]
    return rows, out


def fit(docs: DataFrame, labels: DataFrame) -> Model | float:
    """The model, or the constant score where labels tell nothing apart."""
    learned, share = learned_texts(docs, labels)
    if share is None:
        return 0.0
    learned = materialize(learned, "toxicity-learned")
    terms = index_terms(learned)
    if not terms:
        return float(share)
    rows, found = document_frequencies(docs, terms)
    idf = np.log((1 + rows) / (1 + found)) + 1

    def start():
        vectors = Vectors(terms)

        def step(ids, toxic, texts):
            ids_of, w = zip(*(vectors.weigh(t, idf) for t in texts))
            return ids, toxic, [x.tolist() for x in ids_of], [x.tolist() for x in w]
        return step

    digest = F.xxhash64(F.col("doc_id").cast("string"), F.lit(17))
    examples = []
    for label in (0, 1):
        chosen = learned.where(F.col("toxic") == label).orderBy(digest, "doc_id").limit(INDEX_ROWS)
        weighed = map_rows(
            chosen.select("doc_id", "toxic", "text").repartition(8, "doc_id"),
            f"doc_id {learned.schema['doc_id'].dataType.simpleString()}, toxic int, "
            "terms array<bigint>, weights array<double>", start)
        examples += [(r["doc_id"], r["toxic"], np.array(r["terms"], np.int64), np.array(r["weights"]))
                     for r in weighed.collect() if r["terms"]]
    if not examples:
        return float(share)
    examples.sort(key=lambda e: str(e[0]))
    model = Model(terms, idf, Index.of(examples, len(terms) + 1), float(share))

    def votes():
        find = model.finder()

        def step(ids, toxic, texts):
            found = [find(t, without=i) for i, t in zip(ids, texts)]
            return toxic, [model.vote(*f) if len(f[0]) else None for f in found]
        return step

    got = map_rows(learned.select("doc_id", "toxic", "text"), "toxic int, vote double", votes) \
        .where("vote IS NOT NULL").collect()  # at most 2 * LEARN_ROWS
    model.calibrate(np.array([r["vote"] for r in got]), np.array([r["toxic"] for r in got], np.float64))
    return model


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (the neighbours, best first)."""
    model = fit(docs, labels)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    evidence = f"array<struct<doc_id:{id_type},toxic:int,cosine:double>>"
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    if not isinstance(model, Model):
        return rows.select(
            "doc_id", "held_out", F.lit(model).alias("score"),
            F.lit(int(model >= 0.5)).alias("predicted"), F.array().cast(evidence).alias("evidence"))

    def start():
        find = model.finder()

        def step(ids, held, texts):
            found = [find(t) for t in texts]
            scores = [model.score(*f) for f in found]
            return ids, held, scores, [int(s >= 0.5) for s in scores], [
                [{"doc_id": model.index.ids[p], "toxic": int(model.index.toxic[p]), "cosine": c}
                 for p, c in zip(places.tolist(), cosines.tolist())] for places, cosines in found]
        return step

    return map_rows(rows, f"doc_id {id_type}, held_out boolean, score double, predicted int, "
                          f"evidence {evidence}", start)
