"""The pipeline as a whole, on documents whose fate is known."""

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from seqlake.llm import personal_data
from seqlake.llm.rows import table
from seqlake.llm.vocabulary import BYTE_BPE
from test_near_duplicates import brute as near_groups


def brute(rows, items):
    """rows: (doc_id, text) of `documents`. What is left, and its token ids, one step at a time."""
    rows = [(d, t) for d, t in rows if t and any(c.isalpha() for c in t)]
    component = {d: c for d, _, c in near_groups(rows, pipeline.SHINGLE_WORDS, pipeline.PERCENT)}
    rows = [(d, t) for d, t in rows if component[d] == d]
    flat = lambda t: f" {' '.join(pipeline.decontaminate.words_of(t))} "
    rows = [(d, t) for d, t in rows if not any(flat(i) in flat(t) for i in items)]
    model = personal_data.train(*counted([t for _, t in rows]))
    library = Tokenizer.from_file(BYTE_BPE)
    out = {}
    for d, t in rows:
        base, more = personal_data.all_spans(t, model)
        for kind, start, end in sorted(base + more, key=lambda s: -s[1]):
            t = t[:start] + f"[{kind.upper()}]" + t[end:]
        ids = np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        out[d] = (ids, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                  hashlib.sha256(t.encode()).hexdigest())
    return out


def counted(texts):
    seen = {}
    for t in texts:
        for part in personal_data.candidates(t):
            for span in part:
                pattern = personal_data.votes(t, span)
                seen[pattern] = seen.get(pattern, 0) + 1
    return sorted(seen), [seen[p] for p in sorted(seen)]


def test_run_over_the_whole_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    items = [r["text"] for r in table(spark, sf_dir, "benchmark").collect()]
    got = {r["doc_id"]: (bytes(r["ids"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in pipeline.run(spark, sf_dir).collect()}
    assert got == brute(rows, items)
    assert len(got) < len(rows)


def test_stages():
    assert [name for name, _ in pipeline.STAGES] \
        == ["language", "near_duplicates", "decontamination", "personal_data", "bpe"]


@pytest.mark.parametrize("stage", [f for _, f in pipeline.STAGES], ids=lambda f: f.__name__)
def test_a_stage_takes_an_empty_table_and_further_columns(spark, sf_dir, documents, stage):
    docs = documents([])
    out = stage(spark, docs, sf_dir)
    assert out.collect() == []
    if stage is not pipeline.encode_tokens:
        assert out.columns == docs.columns
