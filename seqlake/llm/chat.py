"""Chat formatting with a grammar round trip (operator 2), in DataFrame functions only.

Grammar of a formatted conversation:

    conversation = { "<|im_start|>" role "<|im_sep|>" text "<|im_end|>\\n" }

Role and text hold no control string. Every turn is rendered as it is first, parsed back and
compared; content that does not come back is escaped and must then be identical, or the job fails.
Escaping doubles backslashes and breaks control strings by a backslash after their first
character; the parser undoes it (a backslash before one of \\ | / I).

Turns are first put together in buckets of BUCKET turn numbers and then per conversation, so the
task that owns a very long conversation receives few rows; the formatted conversation itself is one
string by definition.

Defined results: null role or text is empty; a null conv_id is a conversation of its own; rows go
by turn, null turns first, equal turns by role and then text; repeated rows stay; an empty table
gives an empty result. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
BUCKET = 64
#: Control strings of this and of other common templates: `<|`, `</s>`, `[INST]`, `[/INST]`.
CONFLICT = r"(<)(?=\||/s>)|(\[)(?=/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONFLICT, r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|/I])", "$1")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit(SEPARATOR), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """Array of turns (role, text, both unescaped; header and body: lengths in the rendering)."""
    # every turn begins with its start mark; only what follows the last end is empty
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda piece: piece != "")

    def turn(piece: Column) -> Column:
        body_at = F.locate(SEPARATOR, piece)
        role = F.substring(piece, F.lit(len(START) + 1), body_at - 1 - len(START))
        body = F.substring(piece, body_at + len(SEPARATOR), F.length(piece))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"),
                        (F.length(piece) - F.length(body)).alias("header"),
                        F.length(body).alias("body"))

    return F.transform(pieces, turn)


def _comes_back(rendered: Column, role: Column, text: Column) -> Column:
    """Whether the parser finds this one turn. The start mark must stand at the front only and no
    other control string may come from the content."""
    read = parse(rendered)
    marks = F.size(F.split(rendered, r"<\||</s>|\[/?INST\]"))
    return (F.size(read) == 1) & (read[0]["role"] == role) & (read[0]["text"] == text) \
        & (marks == 4)


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, rendered: each turn escaped only where its content conflicts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), text.alias("text"))
    plain = render(F.col("role"), F.col("text"))
    escaped = render(escape(F.col("role")), escape(F.col("text")))
    tried = turns.withColumn("plain", plain).withColumn(
        "rendered", F.when(_comes_back(F.col("plain"), F.col("role"), F.col("text")),
                           F.col("plain")).otherwise(escaped))
    # content that had to be escaped is read back as well; the rest has been above
    checked = F.when(F.col("rendered") == F.col("plain"), F.col("rendered")).when(
        _comes_back(F.col("rendered"), F.col("role"), F.col("text")), F.col("rendered")
    ).otherwise(F.raise_error(F.lit("a turn does not come back from its rendering")))
    return tried.select("conv_id", "turn", "role", "text", checked.alias("rendered"))


def _running(lengths: Column) -> Column:
    """The sums before each element of an array, and of all."""
    return F.aggregate(lengths, F.array(F.lit(0).cast("bigint")), lambda sums, n: F.concat(
        sums, F.array(F.element_at(sums, -1) + n)))


def _spans(turns: Column) -> Column:
    """(start, length) in code points of the assistant's texts in the rendering of some turns."""
    starts = _running(F.transform(turns, lambda t: (t["header"] + t["body"] + len(END)).cast("bigint")))
    found = F.transform(turns, lambda t, i: F.when(t["role"] == "assistant", F.struct(
        (F.get(starts, i) + t["header"]).alias("start"), t["body"].cast("bigint").alias("length"))))
    return F.filter(found, lambda span: span.isNotNull())


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, and loss_mask: (start, length) in code points of `formatted`, from 0, of the
    assistant's texts, in order."""
    turns = format_turns(conversations)
    row = F.struct("turn", "role", "text", "rendered")
    # sums run over the turns of a bucket and over the buckets of a conversation, both short lists
    buckets = turns.withColumn("bucket", F.floor(F.col("turn") / BUCKET)) \
        .groupBy("conv_id", "bucket").agg(F.array_sort(F.collect_list(row)).alias("rows")) \
        .select("conv_id", "bucket", F.array_join(F.col("rows.rendered"), "").alias("part")) \
        .withColumn("spans", _spans(parse(F.col("part"))))
    whole = buckets.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "part", "spans"))).alias("parts"))
    placed = whole.withColumn("starts", _running(F.transform(
        "parts", lambda p: F.length(p["part"]).cast("bigint"))))
    mask = F.flatten(F.transform("parts", lambda p, i: F.transform(p["spans"], lambda span: F.struct(
        (span["start"] + F.get("starts", i)).alias("start"), span["length"].alias("length")))))
    return placed.select("conv_id", F.array_join(F.col("parts.part"), "").alias("formatted"),
                         mask.alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask and the turns that a reader finds in `formatted`."""
    return formatted.select(
        "conv_id", "formatted", "loss_mask", parse(F.col("formatted")).alias("turns"))


def masked_text(formatted: Column, mask: Column) -> Column:
    """What the mask covers, unescaped. Code points have four bytes each here, so each span is cut
    without a walk over what is before it."""
    wide = F.encode(formatted, "UTF-32")
    cut = F.transform(mask, lambda span: unescape(F.decode(F.substring(
        wide, (4 * span["start"] + 1).cast("int"), (4 * span["length"]).cast("int")), "UTF-32")))
    return F.array_join(cut, "")


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    turns = F.col("turns")
    whole = F.array_join(F.transform(
        turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(format_conversations(conversations)).select(
        "conv_id", F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(F.encode(whole, "utf-8"), 256).alias("turns_sha256"),
        masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    ).select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("loss", "utf-8"), 256).alias("loss_sha256"), "formatted_chars")
