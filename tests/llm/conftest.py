import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, key int, cls string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with nulls, empty and long texts, repeated rows and columns of clashing names."""
    def make(texts, langs=None, ids=None):
        rows = [(ids[i] if ids else i, t, langs[i] if langs else "en", f"s{i % 12}", 0, "x", 1, "y")
                for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)
    return make
