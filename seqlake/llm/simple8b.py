"""Token ids in binary files, packed with Simple-8b (operator 6).

A 64-bit word has a selector (upper 4 bits) that says how many values of which width its lower 60
bits hold, first value lowest. Selector 0 is an escape: the next word holds one raw value of more
than 60 bits. A payload is a header, the word and value offsets of every block of BLOCK words, and the words:
a block can be decoded alone, and all words of one selector are decoded in one step. A last word
that has room left is filled with zeros, which the stored number of values cuts off.

Files are Parquet with one row per run of whole documents (their ids, lengths and one payload), so
Spark's writers commit them and a lost executor only repeats its part. A run is closed as soon as it
has RUN_IDS ids or RUN_DOCS documents; a document is never split.

Defined results: a null or empty text is its end id alone; rows are written in ascending doc_id
order, null ids first, rows of one id by a hash of their text and then by text; an empty table
gives empty files.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string
from tokenizers import Tokenizer

from seqlake.llm.bpe import byte_symbols
from seqlake.llm.rows import map_arrow, map_rows, per_worker
from seqlake.llm.vocabulary import BYTE_BPE, LETTERS, PieceEncoder, broadcast_file
from seqlake.session import scratch_path

BLOCK = 1024
RUN_IDS = 1 << 18
RUN_DOCS = 4096
END_ID = 0
#: Words that a writing task remembers, some 200 bytes each.
REMEMBERED = 400_000
MAGIC = 0x31423853  # "S8B1"
#: (values per word, bits per value) of selectors 1 to 14; fixed values.
LAYOUTS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12),
           (4, 15), (3, 20), (2, 30), (1, 60)]
#: Values in a word of each selector; the unused selector 15 and raw words have none.
COUNTS = np.array([1, *(c for c, _ in LAYOUTS), 0])
FILE_SCHEMA = ("file_no int, run_no int, run_start bigint, doc_ids array<bigint>, "
               "lengths array<bigint>, payload binary")


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; a float's exponent is exact below 2**53."""
    low = np.frexp(values.astype(np.float64))[1]
    if not len(values) or int(values.max()) < 1 << 50:
        return low.astype(np.uint8)
    big = values >> np.uint64(50)
    return np.where(big > 0, np.frexp(big.astype(np.float64))[1] + 50, low).astype(np.uint8)


def _widest_ahead(width: np.ndarray) -> dict[int, np.ndarray]:
    """For each layout's count c: the largest width among the c values from each position on."""
    n = len(width)

    def joined(known: np.ndarray, shift: int) -> np.ndarray:
        out = known.copy()
        if n > shift:
            np.maximum(known[:-shift], known[shift:], out=out[:-shift])
        return out

    doubled = {1: width}
    for c in (1, 2, 4, 8, 16):
        doubled[2 * c] = joined(doubled[c], c)
    halves = {c: 1 << (c.bit_length() - 1) for c, _ in LAYOUTS}
    return {c: joined(doubled[h], c - h) if c > h else doubled[h] for c, h in halves.items()}


def pack(values: np.ndarray) -> bytes:
    """The payload of an array of unsigned integers."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    most = _widest_ahead(_bit_lengths(values))
    # a layout that fits is followed by layouts that fit: fewer values, more bits for each
    fits = np.zeros(n, np.uint8)
    for count, bits in LAYOUTS:
        fits += most[count] <= bits
    choice = np.where(fits > 0, np.uint8(len(LAYOUTS) + 1) - fits, np.uint8(0))
    step = COUNTS[choice].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    first = np.array(starts, np.int64)
    chosen = choice[first]
    sizes = np.where(chosen == 0, 2, 1)
    slot = np.cumsum(sizes) - sizes
    words = np.zeros(int(sizes.sum()), np.uint64)
    padded = np.concatenate([values, np.zeros(60, np.uint64)])
    for selector in np.unique(chosen):
        of = np.flatnonzero(chosen == selector)
        if selector == 0:
            words[slot[of] + 1] = values[first[of]]
            continue
        count, bits = LAYOUTS[selector - 1]
        word = np.full(len(of), np.uint64(int(selector) << 60))
        for k in range(count):
            word |= padded[first[of] + k] << np.uint64(k * bits)
        words[slot[of]] = word
    offsets = np.stack([slot[::BLOCK], first[::BLOCK]], 1)
    header = np.array([MAGIC, n, len(offsets)])
    return b"".join(a.astype("<u8").tobytes() for a in (header, offsets, words))


def _unpack_words(words: np.ndarray) -> np.ndarray:
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(selector == 0):  # the word after an escape may look like anything
        if not raw[at]:
            raw[at + 1] = True
    counts[raw] = 0
    selector[raw] = len(COUNTS)
    place = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(selector):
        of = np.flatnonzero(selector == s)
        if s == 0:
            out[place[of]] = words[of + 1]
        elif s <= len(LAYOUTS):
            count, bits = LAYOUTS[s - 1]
            mask = np.uint64((1 << bits) - 1)
            for k in range(count):
                out[place[of] + k] = words[of] >> np.uint64(k * bits) & mask
    return out


def unpack(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Values [first, last) of a payload; only the blocks that hold them are decoded."""
    magic, total, n_blocks = map(int, np.frombuffer(payload, "<u8", 3))
    if magic != MAGIC:
        raise ValueError("not a packed payload")
    last = total if last is None else min(last, total)
    if first >= last:
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(payload, "<u8", 2 * n_blocks, 24).astype(np.int64).reshape(-1, 2)
    words = np.frombuffer(payload, "<u8", -1, 24 + 16 * n_blocks)
    begin = int(np.searchsorted(offsets[:, 1], first, "right")) - 1
    end = int(np.searchsorted(offsets[:, 1], last, "left"))
    stop = offsets[end, 0] if end < n_blocks else len(words)
    skip = offsets[begin, 1]
    return _unpack_words(words[offsets[begin, 0] : stop])[first - skip : last - skip]


WORD = re.compile(f"[{LETTERS}]+")


def _leaves_words_whole(file: bytes) -> bool:
    """Whether words of the byte-level pattern reach the tokenizer's model as they are, byte by byte."""
    spec = json.loads(file)
    splits = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    return (not spec.get("normalizer")
            and splits == {k: (spec.get("pre_tokenizer") or {}).get(k) for k in splits}
            and not any(t["content"].strip().isalpha() for t in spec["added_tokens"]))


def library_encoder(file: bytes) -> PieceEncoder:
    """The tokenizers library behind remembered pieces. Its model takes words of the byte-level pattern as
    they are; all else goes through the whole tokenizer."""
    tokenizer = Tokenizer.from_str(file.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    model = tokenizer.model.tokenize
    symbols = byte_symbols()
    space = symbols[32]
    as_bytes = {i: i.to_bytes(4, "little") for i in tokenizer.get_vocab().values()}

    def word(piece: str) -> bytes | None:
        core = piece[1:] if piece[:1] == " " else piece
        if not core.isalpha():
            return None
        if core.isascii():
            spelled = core if core is piece else space + core
        elif WORD.fullmatch(core):
            return pattern_word(piece)
        else:
            return None
        return b"".join([as_bytes[token.id] for token in model(spelled)])

    def pattern_word(piece: str) -> bytes:
        if piece.isascii() and "\n" not in piece:
            spelled = piece.replace(" ", space)
        else:
            spelled = "".join([symbols[b] for b in piece.encode()])
        return b"".join([as_bytes[token.id] for token in model(spelled)])

    def encode(text: str) -> bytes:
        return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    mark = encode("\n")

    def encode_all(pieces: list[str]) -> list[bytes]:
        """One call for all pieces, a line each: a line break beside a piece is a token of its own.
        Where the tokens do not fall apart into as many lines, piece by piece."""
        if len(pieces) > 1 and len(mark) == 4 and "\n" not in pieces:
            ids = np.frombuffer(encode("\n".join(pieces)), "<u4")
            cuts = np.flatnonzero(ids == np.frombuffer(mark, "<u4")[0])
            if len(cuts) == len(pieces) - 1:
                data, starts = ids.tobytes(), [0, *((cuts + 1) * 4).tolist()]
                ends = [*(cuts * 4).tolist(), len(data)]
                return [data[i:j] for i, j in zip(starts, ends)]
        return [encode(p) for p in pieces]

    if not _leaves_words_whole(file):
        return PieceEncoder(encode, encode_all)
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    return PieceEncoder(encode, encode_all, word, pattern_word, added, REMEMBERED)


def write_token_files(docs: DataFrame, target: str, path: str = BYTE_BPE) -> None:
    """Tokenize every text with the tokenizers library, append END_ID and write packed files in
    ascending doc_id order. Each task packs one range of ids, run by run."""
    spark = docs.sparkSession
    vocabulary = broadcast_file(spark, path)
    struct = _parse_datatype_string(FILE_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task has one core; the library would start threads of its own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = per_worker(("tokenizers", path), lambda: library_encoder(vocabulary.value))
        end = END_ID.to_bytes(4, "little")
        file_no = TaskContext.get().partitionId()
        schema = to_arrow_schema(struct)
        ids: list[bytes] = []
        doc_ids: list = []
        lengths: list[int] = []
        run_no = run_start = held = 0

        def close() -> pa.RecordBatch:
            payload = pack(np.frombuffer(b"".join(ids), "<u4"))
            row = [[file_no], [run_no], [run_start], [doc_ids], [lengths], [payload]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                own = encoder.ids(text.as_py()) + end
                ids.append(own)
                doc_ids.append(doc_id)
                lengths.append(len(own) // 4)
                held += lengths[-1]
                if held >= RUN_IDS or len(lengths) >= RUN_DOCS:
                    yield close()
                    run_no, run_start, held = run_no + 1, run_start + held, 0
                    ids, doc_ids, lengths = [], [], []
        if doc_ids:
            yield close()

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange(partitions, "doc_id", "tie") \
        .sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    map_arrow(ordered, run, struct).write.parquet(target)


def read_token_files(spark: SparkSession, source: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (binary, little-endian uint32, with the
    end id): one row per stored document."""
    runs = spark.read.schema(FILE_SCHEMA).parquet(source)
    # one row per file, so a single window over them stays small
    totals = runs.groupBy("file_no").agg(F.sum(F.expr(
        "aggregate(lengths, 0L, (a, x) -> a + x)")).alias("total"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "file_no", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("file_start"))

    def start():
        def step(file_start, run_start, doc_ids, lengths, payload):
            out: tuple[list, list, list] = ([], [], [])
            for base, offset, docs, sizes, data in zip(
                    file_start, run_start, doc_ids, lengths, payload):
                ids = unpack(data).astype("<u4")
                at = 0
                for doc, size in zip(docs, sizes):
                    out[0].append(doc)
                    out[1].append(base + offset + at)
                    out[2].append(ids[at : at + size].tobytes())
                    at += size
            return out
        return step

    placed = runs.join(F.broadcast(starts), "file_no").select(
        "file_start", "run_start", "doc_ids", "lengths", "payload")
    return map_rows(placed, "doc_id bigint, start bigint, ids binary", start)


def token_file_digests(docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 as read back from freshly written files."""
    target = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, target, path)
    return read_token_files(docs.sparkSession, target).select(
        "doc_id", "start", F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
