"""Tables and fixtures of the training-data tests."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, words string, "
        "key long, row long, digest string, node long, label string")


@pytest.fixture()
def make_docs(spark):
    """Documents with extra columns whose names the operators use inside."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, True, "w", 1, 2, "d", 3, "l") for i, t in rows], DOCS)
    return make
