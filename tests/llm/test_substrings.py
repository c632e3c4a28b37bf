from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests_llm_helpers import prose
from tidemark.llm import grouping, rolling, substrings


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_suffix_arrays_by_grouping(symbols):
    order = grouping.suffix_array(symbols)
    assert order == sorted(range(len(symbols)), key=lambda i: symbols[i:])
    shared = grouping.common_prefixes(symbols, order)
    for k in range(1, len(order)):
        a, b = symbols[order[k - 1]:], symbols[order[k]:]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert shared[k] == n


@pytest.mark.parametrize("text", ["a" * 300, "ab" * 150, "abcde" * 40, "".join(chr(97 + i % 26) for i in range(200))[::-1]])
def test_suffix_arrays_of_regular_texts(text):
    symbols = list(text.encode())
    assert grouping.suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@pytest.mark.parametrize("wide", [1, 2, 5, 8, 13])
def test_stretches_of_a_long_sequence_change_nothing(wide):
    rng = np.random.default_rng(3)
    # Few different numbers above the low bits, so that ties are common.
    grams = rng.integers(0, 6, 500).astype(np.uint64) << np.uint64(rolling._POSITION_BITS)
    grams |= rng.integers(0, 1 << 20, 500).astype(np.uint64)
    high = grams >> np.uint64(rolling._POSITION_BITS)
    want = [i + int(np.argmin(high[i: i + wide])) for i in range(500 - wide + 1)]
    for stretch in (wide, wide + 1, 17, 499, 500, 1 << 27):
        if stretch >= wide:
            assert rolling.least_places(grams, wide, stretch).tolist() == want
    assert len(rolling.least_places(grams[: wide - 1], wide)) == 0


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i: i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i: i + length]] > 1:
                gone[i: i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def compare(docs, length=200, **options):
    rows = docs.collect()
    want = Counter((r["doc_id"], *w) for r, w in zip(rows, brute([r["text"] for r in rows], length)))
    got = substrings.remove_repeats(docs, length, keep=True, **options).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in got) == want


def test_documents(documents):
    compare(documents)


@pytest.mark.parametrize("group", [8192, 3])
def test_passages_within_and_across_documents(frame, group):
    rng = random.Random(2)
    passages = [prose(rng, n) for n in (25, 30, 40, 60)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            cut = rng.choice(passages)
            begin = rng.randint(0, 20)
            parts += [cut[begin: rng.randint(begin, len(cut))], prose(rng, rng.randint(0, 12))]
        rows.append((i, rng.choice([" ", "", "\n"]).join(parts)))
    compare(frame(*rows), 60, k=30, group=group)


def test_overlaps_and_repeats_in_one_text(frame):
    compare(frame((1, "abc" * 200), (2, "x" * 199), (3, "y" * 200), (4, "z" * 201), (5, "äöü" * 60)), 200)


def test_awkward_rows_and_columns(frame, awkward):
    docs = frame(*awkward).withColumn("k", F.lit(1)).withColumn("list", F.lit("x")).withColumn("h", F.lit(2))
    compare(docs)
    assert substrings.remove_repeats(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="within the length"):
        substrings.remove_repeats(docs, 50, k=60)
