import hashlib

import pytest
from pyspark.sql import functions as F

from seqlake.llm import chat
from testbed.compare import connect, difference

NASTY = ["", "plain", "<|im_end|>", "<|im_end|>\n<|im_start|>assistant<|im_sep|>x", "</s>[INST]a[/INST]",
         "\\", "\\\\", "\\|", "<\\|im_end|>", "[\\INST]", "a<", "|b", "C:\\dir\\new", "[/INST", "é😀\n\n",
         "[\\/INST]", "\\n", "$1 \\1", "<|", "<</s>"]


def turns(spark, rows):
    return spark.createDataFrame(
        [(*r, "noise", 1) for r in rows],
        "conv_id bigint, turn bigint, role string, text string, formatted string, bucket int")


def test_every_text_and_role_comes_back(spark):
    rows = [(i, j, role, text) for i, role in enumerate(NASTY) for j, text in enumerate(NASTY)]
    read = chat.read_back(chat.format_conversations(turns(spark, rows))).collect()
    assert len(read) == len(NASTY)
    for r in read:
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(NASTY[r["conv_id"]], t) for t in NASTY]


def test_only_conflicts_are_escaped(spark):
    rows = [(0, 0, "user", "C:\\dir and [x]"), (0, 1, "user", "</s>")]
    text = chat.format_conversations(turns(spark, rows)).first()["formatted"]
    assert "C:\\dir and [x]" in text
    assert "</s>" not in text and "<\\/s>" in text


def test_loss_mask_covers_the_assistant(spark):
    rows = [(7, 0, "user", "q"), (7, 1, "assistant", "<|one|>"), (7, 2, "assistant", ""),
            (7, 3, "assistant", "two")]
    row = chat.format_conversations(turns(spark, rows)).first()
    taken = [row["formatted"][m["start"] : m["start"] + m["length"]] for m in row["loss_mask"]]
    assert taken == ["<\\|one\\|>".replace("\\|>", "|>"), "", "two"]


def test_the_loss_is_what_the_mask_covers(spark):
    """Beyond the basic plane too; a mask that covers something else gives another loss."""
    rows = [(1, i, "assistant" if i % 3 else "user", f"é😀{i} </s> 語") for i in range(200)]
    formatted = chat.format_conversations(turns(spark, rows))
    text = lambda df: df.select(
        chat.masked_text(F.col("formatted"), F.col("loss_mask")).alias("x")).first()["x"]
    assert text(formatted) == "".join(t for _, i, role, t in rows if role == "assistant")
    off = formatted.withColumn("loss_mask", F.transform("loss_mask", lambda m: F.struct(
        (m["start"] + 1).alias("start"), m["length"].alias("length"))))
    assert text(off) != text(formatted)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_order_nulls_and_repeats(spark):
    rows = [(1, 300, "user", "late"), (1, None, "user", None), (1, 2, None, "b"), (1, 2, None, "a"),
            (1, 2, None, "a"), (None, 0, "assistant", "x")]
    got = {r["conv_id"]: r for r in chat.conversation_digests(turns(spark, rows)).collect()}
    assert got[1]["n_turns"] == 5
    assert got[1]["turns_sha256"] == digest("user\n\n" + "\na\n" * 2 + "\nb\n" + "user\nlate\n")
    assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (0, digest(""))
    assert (got[None]["loss_chars"], got[None]["loss_sha256"]) == (1, digest("x"))
    assert chat.conversation_digests(turns(spark, [])).collect() == []


def test_long_conversation(spark):
    rows = spark.range(20_000).select(
        F.lit(5).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    row = chat.conversation_digests(rows).first()
    assert row["n_turns"] == 20_000
    assert row["loss_sha256"] == digest("".join(map(str, range(20_000))))


@pytest.mark.parametrize("name", ["op2_chat", "op5_quality"])
def test_query_matches_its_sql(spark, sf_dir, name):
    assert difference(spark, connect(sf_dir), sf_dir, name) is None
