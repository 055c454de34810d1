"""The entry without the operators for training text, or without a library of theirs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["corpus_pipeline", "tableflow.llm", "sentencepiece", "tokenizers"])
def test_entry_without(missing):
    """All other queries and their SQL stay, whatever keeps the operators from being imported."""
    code = (f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; "
            "from tableflow.queries import ORACLES, QUERIES; "
            "print(set(e.queries()) == set(QUERIES), set(e.oracle_sql()) == set(ORACLES))")
    found = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True,
                           timeout=120, check=True)
    assert found.stdout.split() == ["True", "True"]
