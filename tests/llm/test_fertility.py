from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests_llm_helpers import prose
from tidemark.llm import fertility
from tidemark.llm.queries import PIECE_BPE, vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = vocabulary(PIECE_BPE)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def token_measures(model, text):
    words = WORD.findall(text or "")
    ids = model.encode(" ".join(words))
    if not ids:
        return 0, 0.0, 0.0, 0.0
    n = len(ids)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values())
    return n, sum(map(len, words)) / n, sum(model.is_byte(i) for i in ids) / n, entropy


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def tangled(n=120, seed=2):
    rng = random.Random(seed)
    parts = ["a", "b", "cc", "\n", "\n\n", " ", "\t", "#", "|<", "é", "中文", "🙂", "\x85", "　", "x\n", "a b a b"]
    return [(i, " ".join(rng.choices(parts, k=rng.randint(0, 40)))) for i in range(n)]


def test_measures_equal_brute_force(model, documents, frame, awkward):
    for docs in (documents, frame(*awkward), frame(*tangled())):
        got = Counter()
        for r in fertility.measures(docs, PATH).collect():
            got[(r["doc_id"], *[r[c] for c in BASE], r["n_tokens"], *[round(r[c], 9) for c in fertility.STEPS])] += 1
        want = Counter()
        for r in docs.collect():
            n, *rest = token_measures(model, r["text"])
            want[(r["doc_id"], *base(r["text"]), n, *[round(x, 9) for x in rest])] += 1
        assert got == want


def judged_by_hand(rows):
    """Bands and verdicts from the measures, group by group."""
    size = lambda r: int(math.floor(math.log2(max(1, r["n_words"]))))
    fails = lambda r: r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
    groups = {}
    for r in rows:
        if not fails(r):
            alike = (r["lang"], r["script"], size(r), r["n_words"], r["word_chars"], r["n_tokens"], *[r[m] for m in fertility.STEPS])
            for kind in ("lang", "script"):
                if r[kind] is not None:
                    groups.setdefault((kind, r[kind], size(r)), set()).add(alike)
    limits = {}
    for key, members in groups.items():
        if len(members) >= fertility.BAND_DOCUMENTS:
            limits[key] = {}
            for j, (m, step) in enumerate(fertility.STEPS.items()):
                values = sorted(int(np.floor(x[6 + j] / step + 0.5)) for x in members)
                q1, q2, q3 = (values[math.ceil(len(values) * k / 4) - 1] for k in (1, 2, 3))
                least = fertility.LEAST_FALLBACK / step if m == "fallback_share" else fertility.LEAST_WIDTH * q2
                down, up = (max(k * (q3 - q1 + 1) / 1.349, least) for k in (fertility.BELOW, fertility.ABOVE))
                limits[key][m] = ((q2 - down) * step, (q2 + up) * step)
    out = []
    for r in rows:
        band = limits.get(("lang", r["lang"], size(r))) or limits.get(("script", r["script"], size(r)))
        inside = band is None or all((m == "fallback_share" or r[m] >= low) and r[m] <= high for m, (low, high) in band.items())
        out.append((r["doc_id"], fails(r), not fails(r) and inside))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_verdicts_equal_bands_by_hand(spark, size, monkeypatch):
    if size == "sf0.001":
        monkeypatch.setattr(fertility, "BAND_DOCUMENTS", 5)
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    rows = [r.asDict() for r in fertility.measures(docs, PATH).collect()]
    got = sorted([(r["doc_id"], r["base_failed"], r["kept"]) for r in fertility.judge(docs, PATH).collect()], key=str)
    assert got == judged_by_hand(rows)


def test_junk_goes_and_prose_stays(frame):
    rng = random.Random(6)
    clean = [(i, prose(rng, rng.randint(60, 120))) for i in range(300)]
    signs = [(1000 + i, " ".join(str(rng.randrange(10 ** 6)) for _ in range(80))) for i in range(10)]
    noise = [(2000 + i, " ".join("".join(chr(rng.randrange(0x1400, 0x1600)) for _ in range(5)) for _ in range(80))) for i in range(10)]
    copies = [(3000 + i, clean[0][1]) for i in range(200)]
    got = {r["doc_id"]: r for r in fertility.judge(frame(*clean, *signs, *noise, *copies), PATH).collect()}
    assert sum(got[i]["kept"] for i, _ in clean) >= 297 and all(got[i]["kept"] for i, _ in copies)
    assert not any(got[i]["kept"] for i, _ in signs + noise)
    assert got[2000]["fallback_share"] > 0.5 and got[0]["fallback_share"] == 0


def test_scripts(frame):
    texts = {"latin": "Größe und Maß", "greek": "αβγ", "cyrillic": "Привет мир", "han": "汉字", "kana": "ひらがな", "hangul": "한국어",
             "arabic": "مرحبا", "hebrew": "שלום", "indic": "नमस्ते", "none": "123 !?"}
    got = {r["doc_id"]: r["script"] for r in fertility.measures(frame(*enumerate(texts.values())), PATH).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts)


def test_awkward_rows_and_columns(frame, awkward):
    docs = frame(*awkward).withColumns({"kept": F.lit("x"), "size_class": F.lit(1), "band": F.lit(2), "lang": F.lit(None).cast("string")})
    got = fertility.judge(docs, PATH).collect()
    assert len(got) == len(awkward)
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] == 0)
    assert fertility.judge(docs.limit(0), PATH).count() == 0
