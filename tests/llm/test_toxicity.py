from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_llm_helpers import prose
from tidemark.llm import strings, toxicity

INSULTS = ("grumbler", "nitwit", "blockhead", "scoundrel")


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(20, 80)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(corpus()[1], "doc_id bigint, quality int, toxic int")


def test_held_out_rows_are_judged_well(spark, frame, labels):
    docs, truth = corpus()
    got = toxicity.judge(frame(*docs), labels).collect()
    assert [c for c in got[0].asDict()] == ["doc_id", "held_out", "score", "predicted"]
    want = {d: t for d, _, t in truth}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    out = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == want[r["doc_id"]] for r in out]) > 0.95
    again = {r["doc_id"]: r["score"] for r in toxicity.judge(frame(*docs).repartition(5), labels).collect()}
    assert again == pytest.approx({r["doc_id"]: r["score"] for r in got})


def test_gapped_and_inserted_characters(spark, frame, labels):
    docs, _ = corpus()
    model = toxicity.train(frame(*docs), labels)
    rng = random.Random(9)
    plain = prose(rng, 40)
    variants = ["blockhead", "block-head", "b.l.o.c.k.h.e.a.d", "b l o c k h e a d", "blockkheaad", "Blockhead!"]
    rows = [(i, f"{plain} {v} {v} {plain}") for i, v in enumerate(variants)] + [(100, plain)]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame(*rows), model).collect()}
    assert all(got[i] > got[100] + 0.2 for i in range(len(variants)))


def test_held_out_labels_and_other_columns_have_no_say(frame, labels):
    docs, _ = corpus()
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(frame(*docs).withColumn("lang", F.lit(x)), t) for x, t in (("en", labels), ("de", flipped)))
    assert np.array_equal(a.weights, b.weights) and np.allclose(a.layer, b.layer)


def test_awkward_rows_and_columns(frame, awkward, labels):
    docs, _ = corpus(200)
    model = toxicity.train(frame(*docs), labels)
    rows = frame(*awkward).withColumn("Score", F.lit("x")).withColumn("row", F.lit(1))
    got = toxicity.score(rows, model)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "score"]
    scores = got.collect()
    assert len(scores) == len(awkward) and all(0 <= r["score"] <= 1 for r in scores)
    assert len({r["score"] for r in scores if r["doc_id"] in (1, 2, 3)}) == 1
    assert toxicity.judge(rows.limit(0), labels).count() == 0


def test_without_labels_of_both_kinds_scores_are_constant(spark, frame, labels):
    docs, _ = corpus(50)
    for some, want in ((labels.limit(0), 0.0), (labels.withColumn("toxic", F.lit(0)), 0.0),
                       (labels.withColumn("toxic", F.lit(1)), 1.0), (labels.withColumn("toxic", F.lit(None).cast("int")), 0.0)):
        assert {r["score"] for r in toxicity.judge(frame(*docs), some).collect()} == {want}


def test_decisions_are_kernel_sums():
    """One weight per subsequence scores as the landmarks would."""
    words = [bytes(strings.CODE[np.frombuffer(w.encode(), np.uint8)]) for w in ("idiot", "clown", "abcabc", "zzzzzzzzzzz")]
    base, columns = strings.features(words)
    alpha = np.array([0.5, -1.0, 0.25, 2.0])
    weights = np.zeros(strings.LETTERS ** 3, np.float32)
    weights[columns] = alpha @ base
    codes = np.frombuffer(b"".join(words), np.uint8)
    starts = np.cumsum([0, *map(len, words)])[:-1]
    got, want = strings.decisions(codes, starts, weights, 0.5), strings.kernel(words, base, columns) @ alpha + 0.5
    # Only decisions that could tell are scaled back for repeated letters.
    own = np.maximum(1, strings.own_norms(words))
    plain = (want - 0.5) * own
    assert got - 0.5 == pytest.approx(np.where(np.abs(plain) > 1.5, plain / own, plain), abs=1e-4)


def test_units_join_spelt_out_words():
    data = np.frombuffer("a b c def g-h i éa".encode(), np.uint8)
    codes, starts, of = strings.units(data, np.array([0, len(data)]))
    ends = [*starts[1:].tolist(), len(codes)]
    assert [e - s for s, e in zip(starts.tolist(), ends)] == [3, 3, 2, 1, 2]


def test_a_repeated_id_stays_within_the_bound(spark, frame, labels, monkeypatch):
    docs, _ = corpus()
    rng = random.Random(4)
    one = next(i for i, _ in docs if i % 4 and zlib.crc32(str(i).encode()) % 4 != 2)
    many = docs + [(one, prose(rng, 12)) for _ in range(3000)]
    seen, real = {}, toxicity.checkpointed

    def kept(df, name):
        out = real(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(toxicity, "checkpointed", kept)
    model = toxicity.train(frame(*many), labels, toxic=60, clean=150)
    assert seen["sample"] <= 210 and model.weights is not None


def test_toxic_rows_go(frame, labels):
    docs, truth = corpus()
    kept = toxicity.drop_toxic(frame(*docs), labels)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = {r["doc_id"] for r in kept.collect()}
    assert len(ids & {d for d, _, t in truth if t}) <= 5 and len({d for d, _, t in truth if not t} - ids) <= 5
