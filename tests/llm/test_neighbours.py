from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import graph, neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, picked, k):
    ok = [(i, np.asarray(e, np.float64)) for i, e in rows if i is not None and e is not None and len(e)
          and all(x is not None and np.isfinite(x) for x in e) and any(x != 0 for x in e)]
    want = {}
    for q, v in ok:
        if picked(q):
            scored = sorted((-float(np.dot(v, w)), i) for i, w in ok if i != q and len(w) == len(v))
            want[q] = [(i, -s) for s, i in scored[:k]]
    return want


def compare(spark, rows, picked, column, least, k=20, **options):
    frame = spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA)
    stored = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    want = brute(stored, picked, k)
    got = {}
    for r in neighbours.nearest(frame, column, k, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {q for q, w in want.items() if w}
    exact = dict(stored)
    found = total = 0
    for q, hits in got.items():
        assert [h[0] for h in hits] == list(range(1, len(hits) + 1)) and len(hits) == len(want[q])
        assert [(-s, i) for _, i, s in hits] == sorted((-s, i) for _, i, s in hits)
        for _, i, s in hits:
            if sum(x == i for x, _ in stored) == 1:
                assert s == pytest.approx(float(np.dot(np.float64(exact[q]), np.float64(exact[i]))), abs=1e-9)
        found += len({i for _, i, _ in hits} & {i for i, _ in want[q]})
        total += len(want[q])
    assert found >= least * total


def test_embeddings(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    compare(spark, rows, lambda q: q % 20 == 0, F.col("vec_id") % 20 == 0, 0.95)


def test_random_vectors_over_several_shards_with_a_dense_cluster(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=24)
    vectors = np.concatenate([rng.normal(size=(1200, 24)), centre + 0.01 * rng.normal(size=(400, 24))])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    compare(spark, rows, lambda q: q % 50 == 0, F.col("vec_id") % 50 == 0, 0.9, per_shard=500)


def test_unusable_vectors_ties_and_other_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (9, [0.5, 2.0]), (10, [-1.0, 0.1]), (11, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]),
            (20, [1.0, 0.0]), (40, [3.0]), (60, [1.0, 1.0, 1.0])]
    compare(spark, rows, lambda q: q % 20 == 0, F.col("vec_id") % 20 == 0, 1.0)


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(300 + i, [float(i), 1.0]) for i in range(50)]
    compare(spark, rows, lambda q: q % 20 == 0, F.col("vec_id") % 20 == 0, 1.0, per_shard=100)


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA).withColumn("shard", F.lit(1))
    assert neighbours.nearest(frame, F.col("vec_id") % 20 == 0).count() == 0


def test_pruning_keeps_diverse_edges():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 5], [9, 9]], np.float32)
    kept = graph.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 3, 0, 5]]), 1.2, 3)[0]
    assert kept.tolist() == [1, 3, 5]
