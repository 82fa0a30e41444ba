import os

import pytest

SAMPLE = os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def sample():
    return SAMPLE


@pytest.fixture
def make_docs(spark):
    """Documents from texts or (doc_id, text) pairs, with columns that clash with those of the operators."""

    def make(rows):
        rows = [r if isinstance(r, tuple) else (k, r) for k, r in enumerate(rows)]
        full = [(i, t, "en", "src0", None if t is None else len(t), 7, "x") for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, length int, score string"
        )

    return make


AWKWARD = [
    None, "", " ", "\n\t\x0b\x0c\r", "a", "one two three four", "ééé 日本語    x", "x" * 20_000,
    "same same same same same same", "dup line here\nother\ndup line here\n\n\n", "tie", "tie", "\x1c\x1d \x85 nul\x00mid",
]


@pytest.fixture
def awkward():
    """Nulls, empties, white space, ties, odd characters, long words and texts."""
    return [*AWKWARD, " ".join(f"w{k % 977}" for k in range(60_000))]
