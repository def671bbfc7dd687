import zlib

import pytest

from seqlake.llm import language
from seqlake.llm.rows import table


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = language.identify(docs).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(held) >= 0.97 * len(held)


EN = "The quick brown fox jumps over the lazy dog while the other animals watch from the hill. "
EL = "Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και όλοι κοιτούν από το λόφο. "


@pytest.fixture
def mixed(documents):
    rows = [(i, (EN if i % 2 else EL)[i % 7 :] * 3, "en" if i % 2 else "el") for i in range(60)]
    return rows, documents


def test_labels_and_ids_are_not_inputs(mixed):
    rows, documents = mixed
    model = language.fit_model(documents(rows))
    fresh = documents([(None, EN, "el"), (1, EL, None), (1, EN, None), (2, None, "en"), (3, "", "en"),
                       (4, " 12 ,;", "en"), (5, EN * 4000, None)])
    got = language.identify(fresh, model).collect()
    assert [r["lang_pred"] for r in got] == ["en", "el", "en", "und", "und", "und", "en"]
    assert [r["score"] for r in got[3:6]] == [0.0] * 3
    assert got[0]["held_out"] is False


def test_held_out_rows_teach_nothing(mixed):
    rows, documents = mixed
    held = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 4 == 2]
    wrong = [(i, EN * 3, "el") for i in held] + [(None, EN * 3, "el")] * 50
    model = language.fit_model(documents(rows + wrong))
    assert model.predict([EN])[0] == ["en"]


def test_without_labels(documents):
    docs = documents([(1, EN), (2, None)])
    assert [r["lang_pred"] for r in language.identify(docs).collect()] == ["und", "und"]
    assert language.identify(documents([])).collect() == []


def test_stage_keeps_columns(mixed):
    rows, documents = mixed
    docs = documents([*rows, (500, EN), (501, "123"), (502, None, "en")])
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    found = {r["doc_id"]: r["lang"] for r in kept.collect()}
    assert set(found) == {r[0] for r in rows} | {500}
    assert found[500] == "en"


def test_short_and_long_texts_teach_where_others_are_missing(documents):
    rows = [(i, EN[i % 7 : 60], "en") if i % 2 else (i, EL[i % 7 :] * 120, "el") for i in range(60)]
    fresh = documents([(900, EN), (901, EL)])
    got = language.identify(fresh, language.fit_model(documents(rows))).collect()
    assert [r["lang_pred"] for r in got] == ["en", "el"]
    kept = language.keep_identified(documents([*rows, (902, EL), (903, "12")])).collect()
    assert sorted(r["doc_id"] for r in kept) == [*range(60), 902]


def test_stage_keeps_texts_with_letters_without_a_model(documents):
    docs = documents([(1, EN), (2, "Short"), (3, "12"), (4, None), (5, "")])
    kept = language.keep_identified(docs).collect()
    assert sorted((r["doc_id"], r["lang"]) for r in kept) == [(1, None), (2, None)]
