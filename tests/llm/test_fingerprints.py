from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fingerprints


def weights(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys) if keys else 1.0


def test_estimates_follow_the_generalised_jaccard_similarity(documents):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(documents).collect()}
    assert len(got) == len(rows)
    off = []
    for i, (d, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        r = got[d]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        off.append(r["near_edited"] - jaccard(weights(text), weights(edited)))
        off.append(r["near_next"] - jaccard(weights(text), weights(following)))
    # All texts share the 64 samples of their common words, so even the mean error has a deviation of up to 0.02;
    # that samples are unbiased is for the last test to show.
    assert abs(np.mean(off)) < 0.03 and np.sqrt(np.mean(np.square(off))) < 0.07


def test_awkward_rows(frame, awkward):
    docs = frame(*awkward).withColumn("n", F.lit(1)).withColumn("next", F.lit("x")).withColumn("k1", F.lit(3))
    got = fingerprints.fingerprints(docs).collect()
    assert len(got) == len(awkward)
    by_text = {}
    for d, text in awkward:
        by_text.setdefault(text or "", set()).update(
            r["fingerprint"] for r in got if r["doc_id"] == d and r["n_chars"] == len(text or ""))
    assert by_text[""] == {""} and by_text[" \t\n"] == {""}
    assert all(len(prints) == 1 for text, prints in by_text.items() if text in (awkward[4][1], "a b", "word"))
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (10, 11)}) == 1
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fingerprints.fingerprints(docs.limit(0)).count() == 0


def test_one_document_follows_itself(frame):
    r = fingerprints.fingerprints(frame((5, "a b c d e f g h"))).first()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"a b c d e f a b").hexdigest()


def test_samples_collide_as_often_as_weights_overlap(spark):
    """Two sets with integer and fractional weights."""
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 300) * 1.0, rng.integers(0, 5, 300) * 0.5
    rows = [(0, i, float(x), float(y)) for i, (x, y) in enumerate(zip(a, b))]
    terms = spark.createDataFrame(rows, "k int, i int, a double, b double").withColumn("term", F.xxhash64("i")).drop("i")
    many = [terms.withColumn("term", F.xxhash64("term", F.lit(s))).withColumn("k", F.lit(s)) for s in range(30)]
    union = many[0]
    for m in many[1:]:
        union = union.unionByName(m)
    signed = fingerprints.signatures(union, ["k"], ["a", "b"])
    found = [r[0] for r in signed.select(fingerprints.likeness(F.col("a"), F.col("b"))).collect()]
    assert np.mean(found) == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.03)
