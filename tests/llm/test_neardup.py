from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_llm_helpers import prose
from tidemark.llm import components, neardup

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i: i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    """Links between all pairs, then the smallest id in reach."""
    sets = {}
    for d, text in rows:
        if d is not None:
            sets.setdefault(d, []).append(shingles(text, width))
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                a2, b2 = find(a), find(b)
                root[max(a2, b2)] = min(a2, b2)
    return {d: find(d) for d in ids}, sets


def compare(docs, width, percent, **limits):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, _ = brute(rows, width, percent)
    got = neardup.near_duplicates(docs, width, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and not r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]]
            assert r["kept"] == (r["component_id"] == r["doc_id"])
    sizes = sorted(len(shingles(t, width)) for _, t in rows)
    assert sorted(r["n_shingles"] for r in got) == sizes


def edited(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_documents(documents, width, percent):
    compare(documents, width, percent)


def test_awkward_rows(frame, awkward):
    compare(frame(*awkward), 3, 85)


@pytest.mark.parametrize("small", [12, 2])
def test_one_large_group_of_near_copies(frame, monkeypatch, small):
    """Hubs, then blocks, find the links of buckets too large for all pairs."""
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "BLOCK", 20)
    rng = random.Random(9)
    base = prose(rng, 120).split()
    rows = [(i, edited(rng, base, rng.randint(0, 9))) for i in range(90)]
    rows += [(100 + i, prose(rng, 60)) for i in range(20)]
    compare(frame(*rows), 3, 85)


def test_a_chain_of_links(frame):
    rng = random.Random(4)
    words = prose(rng, 100).split()
    rows = []
    for i in range(12):
        rows.append((i, " ".join(words)))
        words = words[2:] + prose(rng, 2).split()
    compare(frame(*rows), 3, 85)


def test_equal_words_in_other_case_and_space_are_one_class(frame):
    docs = frame((3, "Aa  bB\tcc dd"), (1, "aa bb cc dd"), (2, "aa bb cc de"))
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()}
    assert got == {1: 1, 3: 1, 2: 2}


def test_other_columns_and_empty_tables(frame):
    docs = frame((1, "a b c d")).withColumn("n", F.lit("x")).withColumn("c", F.lit(1)).withColumn("key", F.lit(2))
    assert neardup.near_duplicates(docs).first().asDict() == {
        "doc_id": 1, "n_shingles": 2, "component_id": 1, "kept": True}
    assert neardup.near_duplicates(docs.limit(0)).count() == 0
    assert neardup.drop_near_duplicates(docs.limit(0)).columns == docs.columns


def test_one_of_each_group_stays(frame, awkward):
    rows = awkward + [(20, "p q r s t u"), (21, "p q r s t u")]
    got = neardup.drop_near_duplicates(frame(*rows)).collect()
    want, sets = brute(rows, 5, 80)
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == sorted(d for d in want if want[d] == d)
    assert sum(r["doc_id"] is None for r in got) == 2


def test_rows_that_share_an_id_are_judged_by_their_own_texts(frame):
    rng = random.Random(12)
    a, b, c = (prose(rng, 40) for _ in range(3))
    rows = [(1, a), (1, b), (1, b), (2, a), (2, c), (3, b + " end"), (4, None), (4, a), (None, a), (5, c), (5, "short")]
    got = sorted(((r["doc_id"], r["text"]) for r in neardup.drop_near_duplicates(frame(*rows)).collect()), key=str)
    assert got == sorted([(1, a), (1, b), (2, c), (4, None), (None, a), (5, "short")], key=str)


def test_odd_sketches_tell_similar_sets():
    rng = np.random.default_rng(3)
    limit = neardup.sketch_limit(0.85)
    for _ in range(200):
        values = rng.integers(0, 2**63, 400).astype(np.uint64)
        other = np.concatenate([values[:369], rng.integers(0, 2**63, 31).astype(np.uint64)])
        a, b = (neardup.odd_sketch(neardup.samples(v)) for v in (values, other))
        assert int(np.bitwise_count(a ^ b).sum()) <= limit
    far = rng.integers(0, 2**63, 400).astype(np.uint64)
    assert int(np.bitwise_count(neardup.odd_sketch(neardup.samples(values)) ^ neardup.odd_sketch(neardup.samples(far))).sum()) > limit


def test_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 130 + i) for i in range(30)] + [(7, 7), (None, 3), (200, 199)]
    rng.shuffle(links)
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components.components(frame).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, **{130 + i: 100 for i in range(30)}, 199: 199, 200: 199}
    assert components.components(frame.limit(0)).count() == 0
