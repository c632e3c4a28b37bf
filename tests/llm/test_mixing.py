from __future__ import annotations

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    """Water filling, a source at a time."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, found = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > most * sizes[s]]
        if not over:
            return found | {s: level * w[s] for s in open_}
        for s in over:
            found[s] = most * sizes[s]
            left -= found[s]
            open_.remove(s)
    return found


def checked(docs):
    rows = docs.collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    want = targets(dict(sizes))
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    took, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["size"] * 0 <= r["taken"] <= 2 * r["size"]
        took[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source in sizes:
        assert abs(took[source] - want[source]) <= largest[source] / 2 + 1e-6
    return got


def test_targets_and_takings(documents):
    first = checked(documents)
    again = mixing.mix(documents.repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in first) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_digest_equals_the_operator(documents):
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(mixing.mix_digest(documents).collect()) == sorted(mixing.mix(documents).select(columns).collect())


def test_awkward_rows(frame, awkward):
    checked(frame(*[(*r, s) for r, s in zip(awkward, ["b", None, "a", "Ä", "b"] * 4)]))


def test_one_source_with_one_document_and_one_without_words(frame):
    got = checked(frame((1, "a b c d", "one"), (2, "", "none"), (3, "x " * 50, "z")))
    assert {r["source"]: r["target"] for r in got}["none"] == 0


def test_clashing_columns_give_way(frame):
    docs = frame((1, "a b"), (2, "c")).withColumn("size", F.lit("x")).withColumn("Taken", F.lit(1)).withColumn("copies", F.lit(3))
    got = mixing.mix(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "copies", "size", "source_size", "target", "taken"]
    assert {r["size"] for r in got.collect()} == {1, 2}


def test_empty_table(frame, spark):
    docs = frame((1, "a")).limit(0)
    assert mixing.mix(docs).count() == 0 and mixing.apply_mix(docs).count() == 0


def test_repeats_follow_the_mix(documents):
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.mix(documents).collect()}
    rows = mixing.apply_mix(documents)
    assert rows.columns == documents.columns
    copies = {r["doc_id"]: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert all(copies.get(d, 0) * size == words for d, (size, words) in taken.items() if size)
