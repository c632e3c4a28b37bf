from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tests_llm_helpers import prose  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def sf() -> str:
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def frame(spark):
    """A frame of documents from (id, text) or (id, text, source) rows."""
    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture
def awkward():
    """Rows with nulls, empty and blank texts, repeated rows, one word, other scripts and a very long text."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    some = prose(rng, 120)
    return [(1, None), (2, ""), (3, " \t\n"), (4, "word"), (5, some), (5, some), (6, some), (None, some), (None, None),
            (7, "ÄÖ 中文字 🙂 éa"), (8, long), (9, long[:40_000] + " tail"), (10, "a b"), (11, "a b"), (2**62, some + " more"),
            (-3, "x" * 5000)]
