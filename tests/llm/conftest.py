import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, lang_pred string, spans string"


@pytest.fixture
def docs(spark):
    """``documents`` rows from (doc_id, text[, lang[, source]]), with extra columns whose names clash."""

    def build(rows):
        full = [(*r, *[None] * (4 - len(r)), 0, "x", "x", "x", "x") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build
