import json
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

ODD = [(None, "x", "en", "s", 1), (5, None, "en", "s", 0), (6, "", None, None, 0), (7, "same text " * 40, "en", "s", 1), (8, "same text " * 40, "en", "s", 1), (8, "same text " * 40, "en", "s", 1), (9, "word " * 30000, "en", "s", 1), (10, "  \n\t ", "en", "s", 1), (11, "Ünïcødé 😀 <|endoftext|> don't ﬁ Σ", "en", "s", 1)]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash with inner ones."""
    rows = [(*r, "a", 1.5, 7) for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string, score double, component_id int")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")


def dump(df):
    return sorted((json.dumps(r.asDict(True), sort_keys=True, default=str) for r in df.collect()))
