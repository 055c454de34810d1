"""Small tables for the operators' tests."""

import pytest
from samples import planted


@pytest.fixture(scope="session")
def documents(spark):
    rows = [(doc_id, text, "en", f"src{(doc_id or 0) % 3}" if (doc_id or 0) % 11 else None,
             len(text or ""), 1.5) for doc_id, text in planted()]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
              "n_words double").repartition(5)
