"""Frames for the text operators; the session comes from the tests above."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """``docs(rows)`` is a frame of documents from (doc_id, text) pairs."""

    def make(rows, source="s"):
        return spark.createDataFrame([(i, t, None, source, None) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Null ids and texts, empty and blank texts, repeated rows, marks outside ASCII, a long text."""
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (None, "no id here"), (None, None), (4, "same row"), (4, "same row"),
        (5, "ÄÖ ñandú 中文 🙂 é İstanbul ΟΔΟΣ"), (6, "word " * 60_000), (7, "x" * 200_000), (8, "7" * 100_000),
        (9, "@" * 5_000 + "+" * 5_000), (10, "\n" * 3_000),
    ]
