"""Quality rules with host verdicts (operator 5), in DataFrame functions only.

Each text is measured inside its own row; nothing is exploded or shuffled but one small row per
host and task. Rules turn the measures into failures. Per host (`source`) the share of texts that
fail is shrunk towards all hosts by a beta prior, which is fitted to the hosts' own shares by
their mean and variance: a host with few texts is judged mostly by the prior. On a host whose
shrunk rate is above HOST_LIMIT every text that fails a rule is dropped; elsewhere only the base
rules drop a text. Texts that fail nothing stay on any host.

Defined results: null and empty texts have no words, so they fail the base rule; a null source is a
host of its own; rows with equal ids are measured and counted one by one; an empty table gives an
empty result. Windows of three words are compared by a 64-bit hash within their own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqlake.session import materialize

MIN_WORDS = 50
HOST_LIMIT = 0.5
#: Share of symbols per character, of repeated lines per line and bounds of the mean word length.
MAX_SYMBOLS, MAX_DUP_LINES, WORD_CHARS = 0.1, 0.3, (2.0, 14.0)
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words(text: Column) -> Column:
    """Runs of characters other than the six ASCII blanks."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_lines and MEASURES of every row."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", "source", text.alias("text"), words(text).alias("w"))
    w, n = F.col("w"), F.size("w")
    windows = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(F.slice(
        F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
        F.lit(1), F.greatest(n - 2, F.lit(0))))
    lines = F.filter(F.split("text", "\n"),
                     lambda line: F.length(F.translate(line, BLANKS, "")) > 0)
    counted = found.select(
        "doc_id", "source", n.alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        lines.alias("lines"), windows.alias("windows"))
    # Windows are sorted by hash with their place: equal neighbours repeat. Most texts repeat no
    # window; those are not sorted.
    placed = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    beside = counted.withColumn("placed", placed)
    p = F.col("placed")
    places = F.sort_array(F.filter(F.transform(p, lambda z, i: F.when(
        z["h"].eqNullSafe(F.get(p, i - 1)["h"]) | z["h"].eqNullSafe(F.get(p, i + 1)["h"]), z["i"])),
        lambda i: i.isNotNull()))
    # their places, in order, cover up to three words each
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"),
                              i.alias("last")))
    return beside.select(
        "doc_id", "source", F.col("n_words").cast("bigint"), F.col("word_chars").cast("bigint"),
        F.col("n_symbols").cast("bigint"), F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered["n"], F.lit(0)).cast("bigint").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_failed() -> Column:
    mean = F.col("word_chars") / F.greatest("n_words", F.lit(1))
    return (
        F.col("base_failed") | (F.col("n_symbols") > MAX_SYMBOLS * F.col("word_chars"))
        | (F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"))
        | ~mean.between(*WORD_CHARS)
    )


def host_verdicts(judged: DataFrame) -> DataFrame:
    """source, n_docs, n_failed, rate, shrunk_rate, bad: one row per host."""
    hosts = judged.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("int")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(
        F.avg(rate).alias("mean"),
        # observed variance of the rates less what the hosts' sizes explain by chance
        F.greatest(F.coalesce(F.var_pop(rate), F.lit(0.0)) - F.coalesce(
            F.avg(rate * (1 - rate) / F.col("n_docs")), F.lit(0.0)), F.lit(1e-4)).alias("var"),
    ).select(F.struct(
        F.coalesce(F.col("mean"), F.lit(0.0)).alias("mean"),
        # method of moments: a + b = mean (1 - mean) / var - 1, at least two pseudo-texts
        F.greatest(F.col("mean") * (1 - F.col("mean")) / F.col("var") - 1, F.lit(2.0))
        .alias("strength"))).scalar()
    shrunk = (F.col("n_failed") + prior["mean"] * prior["strength"]) \
        / (F.col("n_docs") + prior["strength"])
    return hosts.select(
        "source", "n_docs", "n_failed", rate.alias("rate"), shrunk.alias("shrunk_rate"),
        (shrunk > HOST_LIMIT).alias("bad"))


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    # small rows, stored so that the texts are measured once
    judged = materialize(measure(docs), "quality-measures") \
        .withColumn("base_failed", base_failed()).withColumn("failed", rule_failed())
    verdicts = host_verdicts(judged).select(F.col("source").alias("host"), "bad")
    joined = judged.join(verdicts, judged["source"].eqNullSafe(verdicts["host"]), "left")
    bad = F.coalesce("bad", F.lit(False))
    return joined.select(
        "doc_id", *MEASURES, "base_failed",
        (~F.col("base_failed") & ~(bad & F.col("failed"))).alias("kept"))
