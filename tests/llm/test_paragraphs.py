from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests_llm_helpers import prose
from tidemark.llm import paragraphs


def removed(docs, **options):
    rows = [(r["doc_id"], r["span"], r["first_word"], r["n_words"], r["kept_in"], r["passage"])
            for r in paragraphs.repeated_passages(docs, **options).collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("group", [8192, 2])
def test_inline_passages_stay_in_the_first_document_only(frame, group):
    rng = random.Random(3)
    passages = [prose(rng, n) for n in (51, 60, 200)]
    rows, clean = [], []
    for i in range(40):
        if i % 4 == 3:
            rows.append((i, prose(rng, 150)))
            clean.append(i)
        else:
            rows.append((i, f"{prose(rng, rng.randint(1, 90))} {passages[i % 4]}\n{prose(rng, rng.randint(1, 90))}"))
    got = removed(frame(*rows), group=group)
    assert {r[0] for r in got} == {i for i in range(3, 40) if i % 4 != 3}
    for doc, _, _, n, keeper, passage in got:
        assert passage == passages[doc % 4] and keeper == doc % 4 and n == len(passage.split())
    left = {r["doc_id"]: r["text"] for r in paragraphs.remove_passages(frame(*rows)).collect()}
    texts = dict(rows)
    for i, text in left.items():
        assert text == (texts[i] if i in clean or i < 3 else texts[i].replace(passages[i % 4] + "\n", ""))


def test_one_replaced_word_is_still_alike_and_short_passages_stay(frame):
    rng = random.Random(6)
    hit = 0
    for _ in range(6):
        words = prose(rng, 70).split()
        other = list(words)
        other[35] = "changed"
        rows = [(1, prose(rng, 40) + " " + " ".join(words)), (2, " ".join(other) + " " + prose(rng, 40))]
        hit += any(r[0] == 2 for r in removed(frame(*rows)))
    assert hit >= 4
    short = prose(rng, 49)
    assert removed(frame((1, prose(rng, 60) + " " + short), (2, short + " " + prose(rng, 60)))) == []


def test_case_and_white_space_do_not_matter(frame):
    rng = random.Random(7)
    text = prose(rng, 55)
    got = removed(frame((1, text.upper().replace(" ", "\t\n")), (2, "before " + text + " after")))
    assert [(r[0], r[2], r[3], r[4]) for r in got] == [(2, 1, 55, 1)]


def test_alike_counts_aligned_shingles():
    words = np.arange(1, 96, dtype=np.uint32)[None, :]
    other = words.copy()
    other[0, 50] = 999
    assert paragraphs.alike(words, words).all()
    flags = paragraphs.alike(words, other)[0]
    assert flags.all()  # one word of 50 replaced leaves 41 of 46 shingles at least
    other[0, 60] = 998
    flags = paragraphs.alike(words, other)[0]
    assert not flags[20:40].any() and flags[0] and flags[1]
    blank = words.copy()
    blank[0, :5] = 0
    assert not paragraphs.alike(words, blank)[0][:5].any()


def test_awkward_rows_and_columns(frame, awkward):
    docs = frame(*awkward).withColumn("k", F.lit(1)).withColumn("list", F.lit("x")).withColumn("row", F.lit(2))
    got = removed(docs)
    # Rows alike in id and text are the first occurrence together; other ids lose their copy, null ids come last.
    assert {r[0] for r in got if r[0] is not None} == {6, 9, 2**62}
    assert sum(r[0] is None for r in got) == 1
    out = paragraphs.remove_passages(docs)
    assert out.columns == docs.columns and out.count() == len(awkward)
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[2**62] == "more" and texts[9].endswith("tail") and texts[1] is None and texts[3] == " \t\n"
    assert paragraphs.remove_passages(docs.limit(0)).count() == 0
    assert removed(docs.limit(0)) == []


def test_a_passage_repeated_in_one_document_stays_once(frame):
    rng = random.Random(8)
    passage = prose(rng, 80)
    got = removed(frame((1, f"{passage} {prose(rng, 30)} {passage}")))
    assert [(r[0], r[2], r[3], r[4]) for r in got] == [(1, 110, 80, 1)]


def test_an_inserted_or_a_deleted_word_is_still_alike(frame):
    rng = random.Random(21)
    for change in (lambda w: w[:30] + w[31:], lambda w: w[:30] + ["inserted"] + w[30:]):
        words = prose(rng, 60).split()
        other = change(words)
        rows = [(1, prose(rng, 60) + " " + " ".join(words) + " " + prose(rng, 60)),
                (2, prose(rng, 60) + " " + " ".join(other) + " " + prose(rng, 60))]
        assert [(r[0], r[2], r[3]) for r in removed(frame(*rows))] == [(2, 60, len(other))]


def test_paragraphs_are_compared_as_sets():
    def jaccard(one, two):
        one, two = ({tuple(w[i: i + 5]) for i in range(46)} for w in (one, two))
        return len(one & two) / len(one | two)

    rng = np.random.default_rng(4)
    table = np.zeros((60, 95), np.uint32)
    base = rng.integers(1, 1000, 95)
    for row in table:
        words = base.copy()
        for _ in range(rng.integers(0, 3)):
            at = rng.integers(0, 80)
            words = [np.delete(words, at), np.insert(words, at, 2000), np.concatenate([words[at:], words[:at]]),
                     np.concatenate([words[: at + 5], words[at: at + 5], words[at:]])][rng.integers(0, 4)]
        words = words[: rng.integers(50, 96)][:95]
        row[: len(words)] = words
    table[50:, :90] = 7
    for row in table[50:]:
        row[rng.integers(0, 90, rng.integers(0, 3))] = 8
    runs = paragraphs.Runs(table, np.zeros(60))
    a, b = np.triu_indices(60, 1)
    mine, other, _, _, _ = runs.compare(a, b)
    some = 0
    for p in [*range(0, len(a), 29), *np.flatnonzero(a >= 50)]:
        one, two = ([row[i: i + 50].tolist() for i in range(46) if row[i + 49]] for row in (table[a[p]], table[b[p]]))
        fit = np.array([[jaccard(x, y) >= 0.8 and (i == j or any(
            w[:5] in [v[k: k + 5] for k in range(46)] and w[-5:] in [v[k: k + 5] for k in range(46)] for w, v in ((x, y), (y, x))))
            for j, y in enumerate(two)] for i, x in enumerate(one)])
        assert np.array_equal(mine[p, : len(one)], fit.any(axis=1)) and np.array_equal(other[p, : len(two)], fit.any(axis=0))
        # What is alike is a candidate for comparison or settled by name.
        assert not (fit.any(axis=1) & ~(runs.possible | runs.equal)[a[p], : len(one)]).any()
        some += fit.any()
    assert some > 5
    clauses = np.zeros((2, 95), np.uint32)
    clauses[0, :50], clauses[1, :50] = np.arange(1, 51), np.roll(np.arange(1, 51), 25)
    assert paragraphs.Runs(clauses, np.zeros(2)).compare(np.array([0]), np.array([1]))[0][0, 0]


def crowd(seed: int, copies: int = 60) -> list[list[int]]:
    """Runs of words around one pick (words 41 to 45): many copies share one side of it, some differ by a word."""
    rng = np.random.default_rng(seed)
    fresh = iter(range(100, 10**6))
    new = lambda n: [next(fresh) for _ in range(n)]
    pick, head, tail, runs = new(5), new(40), new(50), []
    for i in range(copies):
        runs.append(new(40) + pick + tail[: 25 if i % 2 else rng.integers(5, 50)] + list(rng.integers(10**6, 10**7, 50)))
        runs.append(new(40 - rng.integers(5, 40)) + head + pick + new(50))
        runs[-1] = runs[-1][-95:]
    one = head[20:] + pick + tail[:25]
    other = list(one)
    other[19] = next(fresh)
    runs += [new(20) + one + list(rng.integers(10**6, 10**7, 25)), new(20) + other + list(rng.integers(10**6, 10**7, 25))]
    return [(run + new(95))[:95] for run in runs]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_crowded_group_equals_brute_force(seed):
    runs = crowd(seed)
    order = np.random.default_rng(seed).permutation(len(runs))
    table = np.array([runs[i] for i in order], np.uint32)
    rows = pd.DataFrame({"k": 7, "s": np.arange(len(table)), "u": len(table), "at": (46 << 8) | 45,
                         "words": [np.ascontiguousarray(r).tobytes() for r in table]})
    found = paragraphs._verified(rows)
    n = len(table)
    grams = [[tuple(r[i: i + 5]) for i in range(91)] for r in table.tolist()]
    windows = [[set(g[x: x + 46]) for x in range(46)] for g in grams]
    comp, need = list(range(n)), np.zeros((n, 95), bool)
    for a in range(n):
        for b in range(a + 1, n):
            if len(set(grams[a]) & set(grams[b])) < 41:
                continue
            for x in range(46):
                # Copies are aligned here.
                both = windows[a][x] & windows[b][x]
                if len(both) >= 0.8 * len(windows[a][x] | windows[b][x]):
                    comp = [comp[a] if c == comp[b] else c for c in comp]
                    for i in range(x, x + 46):
                        need[a, i: i + 5] |= grams[a][i] in both
                        need[b, i: i + 5] |= grams[b][i] in both
    got = list(range(n))
    for a, b in found.dropna(subset="other")[["s", "other"]].itertuples(index=False):
        got = [got[a] if c == got[b] else c for c in got]
    assert all((got[a] == got[b]) == (comp[a] == comp[b]) for a in range(n) for b in range(n))
    assert len(set(comp)) > 1
    marks = np.zeros((n, 95), bool)
    for s, x, y in found.dropna(subset="x")[["s", "x", "y"]].itertuples(index=False):
        marks[s, x: y] = True
    assert need.any() and not (need & ~marks).any()


def test_the_size_of_a_group_does_not_change_what_is_found(frame):
    # Copies with one replaced word, whose picks have few passage words on one side or the other.
    rng = random.Random(31)
    rows = []
    for i in range(12):
        words = prose(rng, 52).split()
        pick = rng.randint(5, 40)
        other = [*words[:pick], "changed", *words[pick + 1:]]
        rows += [(2 * i, f"{prose(rng, 45)} {' '.join(words)} {prose(rng, 45)}"), (2 * i + 1, f"{prose(rng, 45)} {' '.join(other)} {prose(rng, 45)}")]
    # Continuations of one passage, so that the groups at its end are large.
    passage = prose(rng, 60)
    rows += [(100 + i, f"{prose(rng, 45)} {passage} {prose(rng, 45)}") for i in range(12)]
    whole = removed(frame(*rows))
    assert len(whole) > 11 and removed(frame(*rows), group=1) == removed(frame(*rows), group=5) == whole


def test_hardly_any_paragraph_with_a_replaced_word_is_missed(frame):
    rng = random.Random(17)
    rows = []
    for i in range(80):
        words = prose(rng, 50).split()
        other = [*words[:25], "changed", *words[26:]]
        rows += [(2 * i, prose(rng, 5) + " " + " ".join(words)), (2 * i + 1, prose(rng, 5) + " " + " ".join(other))]
    assert len({r[0] for r in removed(frame(*rows))}) >= 77


def test_rows_alike_in_id_and_text_list_each_span_once(frame, monkeypatch):
    sizes, text = [], prose(random.Random(41), 60)
    whole = paragraphs.clusters

    def spans(keyed, group):
        found = whole(keyed, group)
        grouped = type(found).groupBy

        class Spans:
            def groupBy(self, *names):
                got = grouped(found, *names)

                class Grouped:
                    def agg(self, *columns):
                        out = got.agg(*columns)
                        sizes.extend(r[0] for r in out.select(F.size("list")).collect())
                        return out

                return Grouped()

        return Spans()

    monkeypatch.setattr(paragraphs, "clusters", spans)
    removed(frame(*[(None, text)] * 20, (1, text)))
    assert len(sizes) == 2 and sizes[0] == sizes[1]


def test_texts_are_hashed_once_and_links_inside_a_shard_settled_there(frame, monkeypatch):
    rng = random.Random(51)
    passage = prose(rng, 60)
    docs = frame(*[(i, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for i in range(6)])
    hashed, linked = [], []
    runs, components = paragraphs._runs, paragraphs.components
    monkeypatch.setattr(paragraphs, "_runs", lambda *a, **b: hashed.append(1) or runs(*a, **b))
    monkeypatch.setattr(paragraphs, "components", lambda *a, **b: linked.append(1) or components(*a, **b))
    whole = removed(docs)
    assert len(whole) == 5 and (len(hashed), len(linked)) == (1, 0)
    assert removed(docs, group=2) == whole and len(linked) == 1


def test_the_order_of_a_groups_runs_does_not_change_what_is_found():
    table = np.array(crowd(5), np.uint32)
    rows = pd.DataFrame({"k": 7, "s": np.arange(len(table)), "u": len(table), "at": (46 << 8) | 45,
                         "words": [np.ascontiguousarray(r).tobytes() for r in table]})
    one, two = (paragraphs._verified(r).sort_values(["s", "other", "x"]).reset_index(drop=True)
                for r in (rows, rows.sample(frac=1, random_state=3)))
    assert len(one) > 50 and one.equals(two)


def test_spans_that_stay_are_taken_from_those_that_go():
    rng = np.random.default_rng(9)
    lists = [[{"begin": int(b), "end": int(b + n), "keep": bool(k), "keeper": None if w == 0 else int(w)}
              for b, n, k, w in zip(rng.integers(0, 200, 8), rng.integers(1, 60, 8), rng.integers(0, 3, 8) == 0, rng.integers(0, 5, 8))]
             for _ in range(60)]
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("keep", pa.bool_()), ("keeper", pa.int64())]))
    batch = pa.record_batch([pa.array(range(60), pa.int64()), pa.array(range(60), pa.int64()), pa.array(lists, kind)], names=["d", "h", "list"])
    for part in (batch, batch.slice(7, 20), batch.slice(0, 0)):
        got = [out.column(2).to_pylist() for out in paragraphs._settle(iter([part]))][0]
        for spans, found in zip(part.column(2).to_pylist(), got, strict=True):
            gone = [any(s["begin"] <= w < s["end"] for s in spans if not s["keep"])
                    and not any(s["begin"] <= w < s["end"] for s in spans if s["keep"]) for w in range(261)]
            want = []
            for w in range(260):
                if gone[w] and not (w and gone[w - 1]):
                    end = gone.index(False, w)
                    keepers = [s["keeper"] for s in spans if not s["keep"] and s["keeper"] is not None and s["begin"] < end and s["end"] > w]
                    want += [w, end, min(keepers, default=np.iinfo(np.int64).max)]
            assert found == want
