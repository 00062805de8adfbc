import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n int, label string"


@pytest.fixture
def docs(spark):
    """Documents from texts; ids count from 0 unless given as pairs. Extra columns have names the operators use."""

    def make(texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(
            [(i, t, "en", "s1" if (i or 0) % 3 else "s0", len(t or ""), 5, "x") for i, t in rows], DOCS
        )

    return make
