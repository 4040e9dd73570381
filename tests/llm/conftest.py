import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, th long, text_hash long, score int, fp int, h1 int, kept_text string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text) pairs as documents with extra columns whose names clash with inner ones."""
    def make(pairs):
        rows = [(i, t, "en", "s", len(t or ""), "r", 1, 2, 3, 4, 5, "k") for i, t in pairs]
        return spark.createDataFrame(rows, DOCS)
    return make


LONG = " ".join(f"w{i % 977}" for i in range(20_000))
#: nulls, empty and very long texts, ties and repeated rows
EDGES = [(None, "a line of its own"), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, "Hello there\nHello there"),
         (5, "Hello there\nHello there"), (6, "x"), (7, "été Été\n\nÀ bientôt"), (8, "tail\n"), (9, "x")]
