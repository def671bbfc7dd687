import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """Documents of (doc_id, text) or (doc_id, text, lang) pairs, with columns that operators might
    use for themselves."""
    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", None, "x", 1.5) for r in rows]
        return spark.createDataFrame(
            full, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                  "text_key string, lang_pred double")
    return build


@pytest.fixture
def sf_dir():
    return SF_DIR
