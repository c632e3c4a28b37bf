from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import infill

UNITS = re.compile(r"[^\n]*\n|[^\n]+")


def brute(doc_id, text, percent=100, spm=50):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i: 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def compare(docs, **options):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    out = infill.restore(infill.fill_in_middle(docs, **options))
    got = [tuple(r) for r in out.collect()]
    spm = options.get("suffix_first_percent", 50)
    want = [(d, *brute(d, t, options.get("percent", 100), spm), t or "") for d, t in rows]
    key = lambda r: tuple((x is None, x) for x in r)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


def random_texts(n=400, seed=4):
    rng = random.Random(seed)
    parts = ["\n", "\n\n", "a", "<", ">", "<P", "S>", "<S>", "<M>", "<P>", "é", "🙂", "x y", "\r", "\x0b", " ", "\x85"]
    weights = [6, 2, 8, 2, 2, 1, 1, .3, .3, .3, 3, 2, 3, 1, 1, 1, 1]
    return [(i, "".join(rng.choices(parts, weights, k=rng.randint(0, 30)))) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"percent": 40, "suffix_first_percent": 90}])
def test_equals_brute_force(documents, frame, awkward, options):
    for docs in (documents, frame(*awkward), frame(*random_texts())):
        forms = {r[2] for r in compare(docs, **options)}
    assert forms == {"plain", "psm", "spm"}


def test_long_texts_over_several_stretches(frame, monkeypatch):
    monkeypatch.setattr(infill, "_STEP", 7)
    import numpy as np

    rng, texts = random.Random(8), [t for _, t in random_texts(60, 9)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    first, second = (np.array([rng.randrange(1 << 32) for _ in texts]) for _ in range(2))
    late = np.array([rng.random() < 0.5 for _ in texts])
    out, places, _, plain, _, _ = infill.scatter(data, offsets, first, second, np.zeros(len(texts), bool), late)
    back, again, wrong = infill.gather(out, places, plain, late)
    assert back.tobytes() == data.tobytes() and again.tolist() == offsets.tolist() and not wrong.any()


def test_outputs_without_their_marks_restore_to_null(spark):
    rows = [("psm", "<P>a<S>b<M>c"), ("spm", "<P>a<S>b<M>c"), ("psm", "abc"), ("psm", ""), ("spm", "<S>x<P>y<M>z<M>"),
            ("plain", "a<P>b"), ("psm", "z<P>a<S>b<M>c"), ("spm", "<S>x<P>y<M>z"), ("plain", None), (None, "abc")]
    df = spark.createDataFrame([(i, f, o) for i, (f, o) in enumerate(rows)], "i int, form string, output string")
    got = {r["i"]: r["restored"] for r in infill.restore(df.withColumn("Restored", F.lit(1))).collect()}
    assert got == {0: "acb", 1: None, 2: None, 3: None, 4: None, 5: "a<P>b", 6: None, 7: "yzx", 8: "", 9: None}


def test_clashing_columns_and_no_rows(frame):
    docs = frame((1, "a\nb"), (1, "a\nb")).withColumns({"output": F.lit(1), "h0": F.lit("x"), "row": F.lit(2), "N": F.lit(0)})
    assert len(compare(docs)) == 2
    assert infill.digests(docs.limit(0)).count() == 0
