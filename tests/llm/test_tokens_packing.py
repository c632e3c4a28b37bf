from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, tokens
from tidemark.llm.queries import vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_encode_as_whole_texts(tokenizer, documents):
    encode, rng = tokens.encoder(vocabulary()), random.Random(3)
    signs = list("abcXYZ'’s t.,;:!? \t\n\r\x0b\x0c\x1c\x85\xa0éÉßΣςİıＡ①½ﬁ́‍　中Ü🙂<|>09=_-") + [
        "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "don't", "x,", "9."]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [r["text"] for r in documents.collect()]
    for text in texts:
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == ids(tokenizer, text), text


def test_a_full_cache_starts_again(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "_CACHED_BYTES", 64 * 240)
    monkeypatch.setattr(tokens, "_caches", {})
    encode = tokens.encoder(vocabulary())
    cache = tokens._caches[vocabulary()]
    text = "one, two three four five two one. " + "long" * 100 + " " + " ".join(f"w{i}" for i in range(300))
    for _ in range(3):
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == ids(tokenizer, text)
    assert ("long" * 100).encode() not in cache and sum(len(k) + len(v) + 200 for k, v in cache.items()) <= 64 * 240


def test_limits_equal_brute_force(documents, tokenizer, frame, awkward):
    for docs in (documents, frame(*awkward)):
        lengths = [len(ids(tokenizer, r["text"])) for r in docs.collect()]
        histogram = tokens.length_histogram(docs, vocabulary())
        got = tokens.context_limits(histogram).collect()
        assert Counter({r["context_limit"]: r["documents"] for r in got}) == Counter(lengths)
        for r in got:
            limit = r["context_limit"]
            assert r["total_documents"] == len(lengths) and r["total_tokens"] == sum(lengths)
            assert r["documents_longer"] == sum(n > limit for n in lengths)
            assert r["tokens_longer"] == sum(n for n in lengths if n > limit)
            assert r["truncated_tokens"] == sum(min(n, limit) for n in lengths)
            assert r["quantile"] == pytest.approx(sum(n <= limit for n in lengths) / len(lengths))
        half = tokens.quantile(tokens.context_limits(histogram), 0.5).first()[0]
        assert half == sorted(lengths)[(len(lengths) + 1) // 2 - 1]
        cut = tokens.truncated(histogram, 100).first()
        assert cut["truncated_tokens"] == sum(min(n, 100) for n in lengths)


def test_limits_of_nothing(frame):
    histogram = tokens.length_histogram(frame((1, "a")).limit(0), vocabulary())
    assert tokens.context_limits(histogram).count() == 0
    assert tokens.quantile(tokens.context_limits(histogram), 0.5).first()[0] is None
    assert tokens.truncated(histogram, 5).first()["truncated_tokens"] == 0


def check_packed(docs, tokenizer, capacity, **options):
    got = [r.asDict() for r in packing.best_fit(docs, vocabulary(), capacity, **options).collect()]
    want = Counter()
    for r in docs.collect():
        whole = ids(tokenizer, r["text"]) + [0]
        for k, at in enumerate(range(0, len(whole), capacity)):
            part = whole[at: at + capacity]
            want[r["doc_id"], k, at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), packing.lower_bound(np.array([r["length"] for r in got], np.int64), capacity)


@pytest.mark.parametrize("per_part", [65_536, 40])
def test_every_piece_has_a_place(documents, tokenizer, per_part):
    used, bound = check_packed(documents, tokenizer, 2048, per_part=per_part)
    assert bound <= used <= bound * 1.03 + 1


def test_awkward_documents(frame, awkward, tokenizer):
    check_packed(frame(*awkward), tokenizer, 64, per_part=5)
    assert packing.best_fit(frame((1, "a")).limit(0), vocabulary()).count() == 0


def test_exchange_closes_gaps(frame, spark):
    """Parts that cannot fill their bins alone do so together."""
    rng = random.Random(1)
    rows = [(i, 0, 0, n, 0) for i, n in enumerate([60] * 300 + [40] * 300)]
    rng.shuffle(rows)
    items = spark.createDataFrame(rows, packing.PIECES)
    alone = packing.pack(items, 100, per_part=40, rounds=1).select("sequence_id").distinct().count()
    together = packing.pack(items, 100, per_part=40, rounds=6).select("sequence_id").distinct().count()
    assert 300 <= together <= alone


def best(lengths, capacity):
    """Fewest bins, by trying all placements."""
    found = [len(lengths)]

    def place(rest, bins):
        if len(bins) >= found[0]:
            return
        if not rest:
            found[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + rest[0] <= capacity:
                place(rest[1:], bins[:i] + [bins[i] + rest[0]] + bins[i + 1:])
        place(rest[1:], bins + [rest[0]])

    place(sorted(lengths, reverse=True), [])
    return found[0]


def test_bounds_hold_and_best_fit_is_feasible():
    rng = random.Random(2)
    for _ in range(150):
        capacity = rng.randint(5, 30)
        lengths = np.array([rng.randint(1, capacity) for _ in range(rng.randint(1, 8))], np.int64)
        bins, offsets = packing.best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths)
        assert fill.max() <= capacity and (offsets + lengths).max() <= capacity
        optimum = best(lengths.tolist(), capacity)
        assert packing.lower_bound(lengths, capacity) <= optimum <= len(fill)


def test_pieces_of_rows_that_are_alike_spread_over_parts(spark, monkeypatch):
    largest, real = [], packing.checkpointed

    def seen(df, name):
        out = real(df, name)
        if name == "packing":
            largest.append(out.groupBy("part").count().agg({"count": "max"}).first()[0])
        return out

    monkeypatch.setattr(packing, "checkpointed", seen)
    items = spark.createDataFrame([(None, 0, 0, 700, 5)] * 400, packing.PIECES)
    assert packing.pack(items, 2048, per_part=50).count() == 400
    assert largest[0] < 120
