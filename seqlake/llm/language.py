"""Language identification with a string kernel (operator 8).

Kernel: two texts are compared by the letter 1-, 2- and 3-grams that occur in both (presence, all
lengths blended), divided by the root of the product of their sizes. Letters are lower-cased,
everything else counts as one blank. Nyström: LANDMARKS texts stand for the kernel; a text becomes
its kernel values against them, whitened by the inverse root of the landmarks' own kernel matrix.
n-grams that no landmark has cannot add to any kernel value and are left out of the sizes too.
One-versus-rest kernel ridge regression on these features gives a score per language. A batch of
texts is scored by two matrix products: presence x landmarks, then kernel values x weights.

The classifier is fitted on a bounded sample: PER_LANGUAGE labelled rows of each language, chosen
by a hash of their id, never on held-out rows (crc32(doc_id as text) mod 4 = 2). Texts of SAMPLE_CHARS
characters are taken first; a language that has too few of them is filled up with its shorter and
longer texts that have a letter, of which the first SAMPLE_CHARS[1] characters are read. The driver sees the landmarks' texts and the sample's kernel
values only. Every whole text is then scored.

Defined results: null text or no letter gives `und` and score 0; a null id is not held out and not
learned from; without any labelled row with a letter everything is `und`, and `keep_identified` keeps
the rows with a letter and leaves their `lang` as it is; rows with equal ids are scored one by
one; ties go to the first language in sort order; empty tables give empty results.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqlake.llm.rows import free_name, map_rows, ship_package

LANDMARKS = 128
PER_LANGUAGE = 500
SAMPLE_CHARS = (200, 8_000)
RIDGE = 1e-2
#: Letter classes; letters of larger alphabets share classes.
CLASSES = 128
LETTER = re.compile(r"[^\W\d_]")
ANY_LETTER = r"\\p{L}"


@dataclass
class Alphabet:
    """Class of each code point: 0 for all that are no letters of the landmarks."""

    table: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Alphabet:
        letters = sorted({c for t in texts for c in t.lower() if c.isalpha()})
        table = np.zeros(0x110000, np.uint8)
        for rank, letter in enumerate(letters):
            table[ord(letter)] = 1 + rank % (CLASSES - 1)
        return cls(table)

    def grams(self, text: str) -> np.ndarray:
        """Codes of all 1-, 2- and 3-grams, repeated ones included, runs of blanks as one."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        c = self.table[points]
        c = c[(c > 0) | (np.concatenate(([1], c[:-1])) > 0)].astype(np.int32)
        c = np.concatenate(([0], c, [0]))
        two = c[:-1] * CLASSES + c[1:]
        three = two[:-1] * CLASSES + c[2:]
        return np.concatenate((c, two + CLASSES, three + CLASSES + CLASSES**2))


@dataclass
class KernelModel:
    alphabet: Alphabet
    feature: np.ndarray  # n-gram code -> column, -1 if no landmark has it
    landmarks: np.ndarray  # columns x landmarks, presence over the root of the landmark's size
    languages: list[str]
    weights: np.ndarray | None = None  # landmarks (and a constant) x languages

    @classmethod
    def of(cls, texts: list[str], languages: list[str]) -> KernelModel:
        alphabet = Alphabet.of(texts)
        grams = [np.unique(alphabet.grams(t)) for t in texts]
        codes = np.unique(np.concatenate(grams))
        feature = np.full(CLASSES + CLASSES**2 + CLASSES**3, -1, np.int32)
        feature[codes] = np.arange(len(codes), dtype=np.int32)
        landmarks = np.zeros((len(codes), len(texts)), np.float32)
        for k, g in enumerate(grams):
            landmarks[feature[g], k] = 1 / np.sqrt(len(g))
        return cls(alphabet, feature, landmarks, languages)

    def kernel(self, texts: list[str]) -> np.ndarray:
        """Kernel values, texts x landmarks."""
        presence = np.zeros((len(texts), len(self.landmarks)), np.float32)
        for row, text in zip(presence, texts):
            column = self.feature[self.alphabet.grams(text)]
            row[column[column >= 0]] = 1
        size = np.sqrt(np.maximum(presence.sum(1, keepdims=True), 1))
        return presence @ self.landmarks / size

    def fit(self, kernel: np.ndarray, labels: list[str]) -> None:
        own = (self.landmarks > 0).astype(np.float32)
        among = own.T @ self.landmarks / np.sqrt(own.sum(0))[:, None]
        value, vector = np.linalg.eigh(among.astype(np.float64))
        keep = value > 1e-6 * value.max()
        whiten = vector[:, keep] / np.sqrt(value[keep]) @ vector[:, keep].T
        x = np.hstack([kernel @ whiten, np.ones((len(kernel), 1))])
        y = np.where(np.array(labels)[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        # every language weighs the same, however many rows it has
        share = 1 / np.maximum((y > 0).sum(0), 1)
        w = share[np.argmax(y, 1)] * len(y) / len(self.languages)
        solved = np.linalg.solve(
            x.T @ (x * w[:, None]) + RIDGE * len(x) * np.eye(x.shape[1]), x.T @ (y * w[:, None]))
        self.weights = np.vstack([whiten @ solved[:-1], solved[-1:]]).astype(np.float32)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        margin = self.kernel(texts) @ self.weights[:-1] + self.weights[-1]
        best = margin.argmax(1)
        score = np.clip((margin[np.arange(len(best)), best] + 1) / 2, 0, 1)
        return [self.languages[i] for i in best], score.astype(float).tolist()


def held_out() -> F.Column:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def fit_model(docs: DataFrame) -> KernelModel | None:
    """The model, or None if no row is labelled."""
    spark = docs.sparkSession
    low_chars, high_chars = SAMPLE_CHARS
    usable = docs.select("doc_id", "text", "lang", held_out().alias("held_out")).where(
        "not held_out and doc_id is not null and lang is not null"
    ).select("doc_id", F.substring("text", 1, high_chars).alias("text"), "lang",
             F.xxhash64("doc_id").alias("draw"),
             (~F.length("text").between(low_chars, high_chars)).alias("other"))
    usable = usable.where(f"not other or text rlike '{ANY_LETTER}'")
    # Ids whose hash is below a share of its range go on: some times the rows that are wanted of a
    # language, however many it has. The rank then cuts these to PER_LANGUAGE.
    counts = usable.groupBy("lang", "other").agg(F.count("*").alias("n")).collect()
    if not counts:
        return None
    enough = {r["lang"] for r in counts if not r["other"] and r["n"] >= PER_LANGUAGE}
    share = {(r["lang"], r["other"]): min(1 << 20, -(-4 * PER_LANGUAGE * (1 << 20) // r["n"]))
             for r in counts if not (r["other"] and r["lang"] in enough)}
    low = F.create_map(*[F.lit(x) for (lang, other), n in sorted(share.items())
                         for x in (f"{int(other)}{lang}", n)])
    name = F.concat(F.col("other").cast("int").cast("string"), "lang")
    order = Window.partitionBy("lang").orderBy("other", "draw", "doc_id")
    chosen = usable.select("doc_id", "lang", "draw", "other") \
        .where(F.pmod("draw", F.lit(1 << 20)) < F.element_at(low, name)) \
        .withColumn("rank", F.row_number().over(order)) \
        .where(F.col("rank") <= PER_LANGUAGE).select("doc_id", "lang", "rank", "draw").collect()
    if not chosen:
        return None
    languages = sorted({r["lang"] for r in chosen})
    each = max(1, LANDMARKS // len(languages))
    picked = {(r["doc_id"], r["lang"]): r["rank"] for r in chosen}
    ids = spark.createDataFrame(list(picked), "doc_id bigint, lang string").distinct()
    sample = usable.join(F.broadcast(ids), ["doc_id", "lang"]).select("doc_id", "lang", "text")
    wanted = [k for k, rank in picked.items() if rank <= each]
    first = spark.createDataFrame(wanted, "doc_id bigint, lang string")
    texts = sample.join(F.broadcast(first), ["doc_id", "lang"], "left_semi") \
        .dropDuplicates(["doc_id", "lang", "text"]).orderBy("lang", "doc_id", "text").collect()
    model = KernelModel.of([r["text"] for r in texts], languages)
    shared = spark.sparkContext.broadcast(model)

    def start():
        own = shared.value
        return lambda doc_id, lang, text: (doc_id, lang, own.kernel(text).tolist())

    rows = map_rows(sample, "doc_id bigint, lang string, kernel array<float>", start) \
        .orderBy("doc_id", "lang", "kernel").collect()
    model.fit(np.array([r["kernel"] for r in rows], np.float64), [r["lang"] for r in rows])
    return model


def identify(docs: DataFrame, model: KernelModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of `docs` (columns doc_id, text, lang)."""
    model = model or fit_model(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        own = shared.value

        def step(doc_id, held, text):
            known = [i for i, t in enumerate(text) if own and t and LETTER.search(t)]
            lang, score = ["und"] * len(text), [0.0] * len(text)
            for at in range(0, len(known), 128):
                part = known[at : at + 128]
                for i, name, value in zip(part, *own.predict([text[i] for i in part])):
                    lang[i], score[i] = name, value
            return doc_id, held, lang, score
        return step

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return map_rows(
        rows, "doc_id bigint, held_out boolean, lang_pred string, score double", start)


def keep_identified(docs: DataFrame) -> DataFrame:
    """`docs` without the rows that have no letter; a missing `lang` becomes the predicted one, if
    there is a model. All columns are kept."""
    model = fit_model(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        own = shared.value

        def step(text):
            out: list[str | None] = ["und"] * len(text)
            known = [i for i, t in enumerate(text) if t and LETTER.search(t)]
            if own is None:
                for i in known:
                    out[i] = None
                return out
            for at in range(0, len(known), 128):
                part = known[at : at + 128]
                for i, name in zip(part, own.predict([text[i] for i in part])[0]):
                    out[i] = name
            return out
        return step

    @F.pandas_udf("string")
    def predicted(texts):
        step = start()
        return pd.Series(step([None if t is None else t for t in texts]), index=texts.index)

    ship_package(docs.sparkSession)
    name = free_name(docs, "lang_pred")
    found = docs.withColumn(name, predicted.asNondeterministic()("text"))
    return found.where(F.col(name).isNull() | (F.col(name) != "und")) \
        .withColumn("lang", F.coalesce("lang", name)).select(*docs.columns)
