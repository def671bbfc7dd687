"""The registered queries: names, columns and whole tables."""

import ast
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[2]
COLUMNS = {
    "op1_suffix_repeats": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op2_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op3_decontaminate": "doc_id contaminated items score",
    "op4_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op6_simple8b": "doc_id start n_tokens ids_crc32",
    "op7_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op8_language": "doc_id held_out lang_pred score",
    "op9_html": "page_id url text n_chars",
    "op10_near_duplicates": "doc_id n_shingles component_id kept",
    "op11_divergence": "lang source part item value rank",
    "op12_bit_plane_clusters": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op13_toxicity": "doc_id held_out score predicted",
}
ROWS = {"op2_chat": None, "op9_html": "pages", "op12_bit_plane_clusters": "embeddings"}


@pytest.mark.parametrize("name", COLUMNS)
def test_a_query_returns_a_row_for_every_row(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    assert df.columns == COLUMNS[name].split()
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    if name == "op2_chat":
        want = read("conversations").select("conv_id").distinct().count() + 1
    elif name == "op11_divergence":
        groups = read("documents").select("lang", "source").distinct()
        want = groups.alias("a").join(groups.alias("b"), "lang").where("a.source <> b.source").count()
        df = df.where("part = 'pair'")
    else:
        want = read(ROWS.get(name, "documents")).count()
    assert df.count() == want


def test_pipeline_is_registered():
    assert "pipeline" in entry.queries()


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("seqlake/**/*.py"), *ROOT.glob("testbed/*.py"), *ROOT.glob("tests/*.py")]:
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else \
                [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") or n == "corpus_pipeline" for n in names), path
