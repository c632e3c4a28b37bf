"""Operator 1: toxicity by a subsequence-kernel support vector machine with Nyström landmarks.

Labels are those of documents, so sentences and words inherit them.  Training takes three steps on a bounded sample:

* Words that labelled texts hold, counted over documents (copies and near copies once), become examples: toxic
  those that occur in toxic texts far more often than chance has it, clean those of clean texts.
* The machine learns on Nyström features of the words: kernel values with the landmarks, whitened.  As
  landmarks are sums of subsequence features, the machine is again one weight per subsequence, and
  scoring a word needs no landmark.
* A logistic regression turns a text's three highest decisions and its length into a probability.

Scoring reads whole texts.  Labels, lang, source and id are no input of a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import strings
from tidemark.llm.common import filled, replaced, text_bytes, text_of_rows, text_slices
from tidemark.llm.rolling import FOLDED, Hashed, mix, numbers, word_grams, word_ranges
from tidemark.session import checkpointed

TOXIC_SAMPLE, CLEAN_SAMPLE = 2000, 6000
EXAMPLES, LANDMARKS, TOP, THRESHOLD = 4000, 96, 3, 0.3
_KEYS = numbers(3, 21)


@dataclass(frozen=True)
class Model:
    """One weight per subsequence, the bias, and the logistic layer; ``None`` weights score everything alike."""

    weights: np.ndarray | None
    bias: float
    layer: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not for learning: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample(labels: DataFrame, toxic: int, clean: int) -> DataFrame:
    """Ids and labels for learning: the first of each class in hash order, at most ``toxic`` and ``clean``."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.avg("toxic") >= 0.5).alias("toxic")))
    parts = [known.filter(kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
             for kind, n in ((F.col("toxic"), toxic), (~F.col("toxic"), clean))]
    return parts[0].unionByName(parts[1])


def _types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different units of each text, with keys that near copies mostly share."""
    for batch in batches:
        texts, toxic = filled(batch, "text"), batch.column(1).to_pylist()
        for i in range(len(texts)):
            data, offsets = text_bytes(texts.slice(i, 1))
            codes, starts, _ = strings.units(data, offsets)
            blob, ends = codes.tobytes(), np.append(starts[1:], len(codes))
            types = {blob[b:e] for b, e in zip(starts.tolist(), ends.tolist()) if e - b > 2}
            begin, end, _ = word_ranges(data, offsets)
            words = mix(Hashed(FOLDED[data]).ranges(begin, end))
            grams = word_grams(words, 3) if len(words) >= 3 else words
            keys = [int(mix(grams ^ k).min().view(np.int64)) if len(grams) else 0 for k in _KEYS]
            n = len(types)
            yield pa.record_batch(
                [pa.array(list(types), pa.binary()), pa.array([toxic[i]] * n, pa.bool_()),
                 *[pa.array([k] * n, pa.int64()) for k in keys]], names=["unit", "toxic", "k0", "k1", "k2"])


def _tops(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text its ``TOP`` highest decisions of units, and the logarithm of the number of units."""
    n = len(offsets) - 1
    out = np.full((n, TOP + 1), min(model.bias, -1.0))
    out[:, TOP] = 0
    codes, starts, of = strings.units(data, offsets)
    if len(starts):
        value = strings.decisions(codes, starts, model.weights, model.bias)
        out[:, TOP] = np.log1p(np.bincount(of, minlength=n))
        for slot in range(TOP):
            firsts = np.flatnonzero(np.diff(of, prepend=-1))
            best = np.maximum.reduceat(value, firsts)
            out[of[firsts], slot] = np.maximum(best, out[of[firsts], slot])
            value = np.where(value == np.repeat(best, np.diff(np.append(firsts, len(of)))), -np.inf, value)
    return np.clip(out, -10, 20)


def _scores(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if model.weights is None:
        return np.full(len(offsets) - 1, model.layer[-1])
    return 1 / (1 + np.exp(-np.clip(_tops(model, data, offsets) @ model.layer[:-1] + model.layer[-1], -30, 30)))


def _machine(bad: list[tuple[bytes, float]], good: dict[bytes, float], landmarks: list[bytes]) -> tuple[np.ndarray, float]:
    """One weight per subsequence and the bias of a machine trained on whitened kernel values."""
    base, columns = strings.features(landmarks)
    values, vectors = np.linalg.eigh(base @ base.T)
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    words = [w for w, _ in bad] + list(good)
    y = np.concatenate([np.ones(len(bad)), -np.ones(len(good))])
    # Each class counts half; within one, words by the root of their documents.
    support = np.sqrt(np.array([s for _, s in bad] + list(good.values())))
    support[y > 0] /= support[y > 0].sum()
    support[y < 0] /= support[y < 0].sum()
    machine = strings.fit_svm(strings.kernel(words, base, columns) @ whiten, y, support)
    weights = np.zeros(strings.LETTERS ** 3, np.float32)
    weights[columns] = (whiten @ machine[:-1]) @ base
    return weights, float(machine[-1])


def _decided(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            words = batch.column(0).to_pylist()
            codes = np.frombuffer(b"".join(words), np.uint8)
            starts = np.cumsum([0, *map(len, words)])[:-1]
            value = strings.decisions(codes, starts, weights, bias)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(value)], names=["unit", "c", "value"])

    return run


def train(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC_SAMPLE, clean: int = CLEAN_SAMPLE) -> Model:
    """Learn from at most ``toxic`` and ``clean`` labelled ids, and as many different texts; a bounded number of words reaches
    the driver.  Where ids repeat and hold more texts than that, the first in hash order count.

    Without labelled texts of both kinds all texts get the share of toxic ones among those labelled (0 if none).
    """
    wanted = _sample(labels, toxic, clean)
    labelled = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("h"))
                .join(F.broadcast(wanted), "doc_id").select("toxic", "h", "text"))
    # Only hashes are put in order; at most ``toxic + clean`` rows are broadcast.
    hashes = checkpointed(labelled.select("toxic", "h").distinct(), "sample-hashes")
    first = [hashes.filter(kind).orderBy("h").limit(n) for kind, n in ((F.col("toxic"), toxic), (~F.col("toxic"), clean))]
    texts = checkpointed(labelled.join(F.broadcast(first[0].unionByName(first[1])), ["toxic", "h"], "left_semi")
                         .groupBy("toxic", "h").agg(F.min("text").alias("text")).select("text", "toxic"), "sample")
    counts = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    n_toxic, n_clean = counts.get(True, 0), counts.get(False, 0)
    constant = Model(None, 0.0, np.array([n_toxic / max(1, n_toxic + n_clean)]))
    if not n_toxic or not n_clean:
        return constant
    types = texts.mapInArrow(_types, "unit binary, toxic boolean, k0 bigint, k1 bigint, k2 bigint")
    spread = [F.least(*[F.count_distinct(F.when(F.col("toxic") == kind, F.col(f"k{j}"))) for j in range(3)]).alias(name)
              for kind, name in ((True, "t"), (False, "c"))]
    counted = checkpointed(types.groupBy("unit").agg(*spread), "types")
    share = n_toxic / (n_toxic + n_clean)
    n = F.col("t") + F.col("c")
    q = F.col("t") / n
    # Chernoff's bound on the chance of so many toxic texts, against the number of words tried.
    rest = F.when(q < 1, (1 - q) * F.ln((1 - q) / (1 - share))).otherwise(0)
    evidence = n * (q * F.ln(q / share) + rest)
    enough = math.log(max(1, counted.count())) + 2
    chosen = [counted.filter((F.col("t") >= 3) & (q >= 0.7) & (evidence >= enough)).orderBy(F.desc("t"), "unit"),
              counted.filter((F.col("c") > 0) & (q <= 0.5)).orderBy(F.desc("c"), "unit"),
              counted.filter((F.col("c") > 0) & (q <= 0.5)).orderBy(F.xxhash64("unit"), "unit")]
    bad, common, rare = ([(bytes(r["unit"]), float(r["t"] if k == 0 else r["c"])) for r in part.limit(EXAMPLES).collect()]
                         for k, part in enumerate(chosen))
    if not bad:
        return constant
    good = dict(common) | dict(rare)
    landmarks = strings.spread_out([w for w, _ in bad], LANDMARKS // 2) + strings.spread_out(
        [w for w, _ in common], LANDMARKS // 4) + strings.spread_out([w for w, _ in rare], LANDMARKS // 4)
    weights, bias = _machine(bad, good, landmarks)
    # The clean words that look most toxic to the first machine teach a second one.
    clean_words = counted.filter((F.col("c") > 0) & (q <= 0.5)).select("unit", "c")
    hard = (clean_words.mapInArrow(_decided(texts.sparkSession.sparkContext.broadcast((weights, bias))),
                                   "unit binary, c bigint, value double")
            .orderBy(F.desc("value"), "unit").limit(EXAMPLES).collect())
    good |= {bytes(r["unit"]): float(r["c"]) for r in hard}
    near = strings.spread_out([bytes(r["unit"]) for r in hard], LANDMARKS // 2)
    weights, bias = _machine(bad, good, list(dict.fromkeys(landmarks + near)))
    model = Model(weights, bias, np.zeros(TOP + 2))
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = filled(batch, "text")
            for begin, end in text_slices(texts, 1 << 19):
                rows = _tops(shared.value, *text_bytes(texts.slice(begin, end - begin)))
                yield pa.record_batch([batch.column(1).slice(begin, end - begin), *[pa.array(c) for c in rows.T]],
                                      names=["toxic", *[f"f{j}" for j in range(TOP + 1)]])

    schema = "toxic boolean, " + ", ".join(f"f{j} double" for j in range(TOP + 1))
    rows: pd.DataFrame = texts.mapInArrow(measure, schema).toPandas().sort_values(
        ["toxic", *[f"f{j}" for j in range(TOP + 1)]])
    layer = strings.fit_logistic(rows.iloc[:, 1:].to_numpy(np.float64), rows["toxic"].to_numpy(np.float64))
    return Model(weights, bias, layer)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a last column ``score``: the chance that the text is toxic; null and empty texts get one too.

    A column of that name gives way; other columns, whatever they are called, stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c.lower() != "score"]
    at = [c.lower() for c in names].index(text.lower())
    picked = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            texts = text_of_rows(rows, at)
            for begin, end in text_slices(texts, 1 << 19):
                value = _scores(shared.value, *text_bytes(texts.slice(begin, end - begin)))
                yield pa.record_batch([rows.slice(begin, end - begin), pa.array(value)], names=["row", "score"])

    schema = "row " + picked.schema["row"].dataType.simpleString() + ", score double"
    return picked.mapInArrow(run, schema).select(*[F.col(f"row.`{c}`").alias(c) for c in names], "score")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Repeated rows are scored alike, a null id is not held out, an empty table stays empty, and without usable labels
    the score is a constant (see ``train``).
    """
    model = train(docs, labels)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``."""
    scored = score(replaced(docs, {}), train(docs, labels))
    return scored.filter(F.col("score") < threshold).drop("score")
