import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows from (doc_id, text), with further columns of clashing names."""

    def make(rows):
        full = [(i, t, "en", "s", 0, True, "x", 7) for i, t in rows]
        return spark.createDataFrame(full, DOCS + ", kept boolean, key string, n_words int").repartition(3)

    return make
