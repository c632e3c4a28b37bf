from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from tidemark.llm import neardup, paragraphs, substrings, tokens
from tidemark.llm.queries import vocabulary


def test_hashing_a_large_batch_takes_little_memory():
    rng = np.random.default_rng(5)
    letters = rng.integers(97, 123, (3000, 3000), np.uint8)
    letters[:, ::7] = 32
    column = pa.array([row.tobytes().decode() for row in letters])
    batch = pa.record_batch([pa.array(range(3000)), pa.array(range(3000)), column], names=["d", "h", "text"])

    class Docs:
        def mapInArrow(self, run, _):
            return run

    for runs in (paragraphs._runs(Docs()), paragraphs._runs(Docs(), keys_only=True), substrings._anchors(Docs(), 200, 100),
                 substrings._anchors(Docs(), 200, 100, keys_only=True), neardup._sets(Docs(), 5)):
        tracemalloc.start()
        for _ in runs(iter([batch])):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        # 9 MB of text; some fifty bytes for each byte of a slice.
        assert most < 80 << 20


def test_a_word_cache_between_tasks_is_small(monkeypatch):
    cache, most = tokens.WordIds(vocabulary()), 0
    monkeypatch.setattr(cache, "_encoded", lambda word: word[:4])
    for n in range(400_000):
        assert cache[b"w%d" % n] == (b"w%d" % n)[:4]
        most = max(most, len(cache))
    # Some 200 bytes for each entry.
    assert most * 200 <= 64 << 20
