from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tidemark.llm import audits, conversations
from tidemark.llm.queries import ORACLES
from workload import check

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def cheapest(faults, initials, start="", goals=("", "a")):
    """Least (cost, audit) by trying everything, with memory but without bounds."""
    @lru_cache(None)
    def go(i, state, inserted):
        found = [(0, "")] if i == len(faults) and state in goals else []
        if inserted < 2:
            for x in "ua":
                if (state, x) in NEXT:
                    found += [(2 + c, "I" + e) for c, e in go(i, NEXT[state, x], inserted + 1)]
        if i < len(faults):
            found += [(3 + c, "D" + e) for c, e in go(i + 1, state, 0)]
            if faults[i] != "x":
                more = faults[i] == "t"
                for edit, cost, letters in (("K", 0, initials[i]), ("R", 2, "ua")):
                    for x in letters:
                        if (state, x) in NEXT:
                            found += [(cost + more + c, edit + e) for c, e in go(i + 1, NEXT[state, x], 0)]
        return tuple(sorted(found)[:1])

    return (go(0, start, 0) or (None,))[0]


def test_search_equals_trying_everything():
    rng = random.Random(1)
    states = ["", "s", "u", "a"]
    for _ in range(400):
        n = rng.randint(0, 9)
        faults, initials = "".join(rng.choices("--xt", k=n)), "".join(rng.choices("suax ", [2, 4, 4, 1, 1], k=n))
        assert audits.search(faults, initials) == cheapest(faults, initials) == audits.best(faults, initials)
        ways = audits.paths(faults, initials)
        for a in range(4):
            for b in range(4):
                assert ways.get((a, b)) == cheapest(faults, initials, states[a], (states[b],))


def test_segments_put_together_equal_one_search(monkeypatch):
    rng = random.Random(2)
    for _ in range(40):
        n = rng.randint(10, 40)
        faults, initials = "".join(rng.choices("---xt", k=n)), "".join(rng.choices("suax", [1, 4, 4, 1], k=n))
        monkeypatch.setattr(audits, "SEGMENT", 1000)
        whole = audits.best(faults, initials)
        monkeypatch.setattr(audits, "SEGMENT", rng.randint(1, 9))
        assert audits.best(faults, initials) == whole == cheapest(faults, initials)


def brute(rows):
    """The whole contract, row by row."""
    convs, damaged = [], defaultdict(list)
    for conv, turn, role, text in rows:
        convs.append(conv)
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        damaged[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv in dict.fromkeys(convs):
        turns = sorted(damaged[conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        faults, seen = "", set()
        for _, role, text in turns:
            signs = re.findall(r"[^\x20\x09-\x0D]", text)
            faults += "b" if not signs else "d" if (role, text) in seen else "-" if signs[-1] in ".!?" else "t"
            seen.add((role, text))
        initials = [role[:1] or " " for _, role, _ in turns]
        dated = [t for t, _, _ in turns if t is not None]
        cost, audit = cheapest(re.sub("[bd]", "x", faults), "".join(initials))
        fixed, i = [], 0
        for e in audit:
            if e == "D":
                i += 1
                continue
            led = bool(fixed) and fixed[0][0][:1] == "s"
            named = "user" if (len(fixed) - led) % 2 == 0 else "assistant"
            fixed.append((turns[i][1] if e == "K" else named, "" if e == "I" else turns[i][2]))
            i += e != "I"
        body = "\n".join(f"{r}:{t}" for r, t in fixed)
        out.append((conv, max(dated) - min(dated) + 1 - len(set(dated)) if dated else 0, faults.count("b"), faults.count("d"),
                    faults.count("t"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256(body.encode()).hexdigest()))
    return out


def compare(df):
    got = [tuple(r) for r in conversations.audit_damaged(df).collect()]
    want = brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


def muddled(n=300, convs=9, seed=3):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "Why?", "cut", "cut. ", " \n", "", None, "end.\x85", "a\nb.\n", "é.", "Yes. \t"]
    return [(rng.choice([None, *range(convs)]), rng.choice([None, *range(40)]), rng.choices(roles, [5, 5, 2, 1, 1, 1])[0],
             rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randrange(60)}.") for _ in range(n)]


def test_given_conversations_equal_brute_force(spark, sf):
    compare(spark.read.parquet(f"{sf}/conversations.parquet"))


def test_muddled_rows_equal_brute_force_and_sql(spark):
    for seed in (3, 4, 5):
        df = spark.createDataFrame(muddled(seed=seed), SCHEMA)
        compare(df.withColumns({"gone": F.lit("x"), "kind": F.lit(1), "large": F.lit(2), "seen": F.lit(3)}))
    con = check.duck("/root/testdata/sf0.001")
    con.register("muddled", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    sql = ORACLES["op13_conversation_repair"].replace("from conversations", "from muddled")
    assert check.compare(conversations.audit_damaged(df), con, sql) is None


@pytest.mark.parametrize("rows", [1, 7, 40])
def test_long_conversations_in_stretches_equal_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(conversations, "ROWS", rows)
    got = compare(spark.createDataFrame(muddled(400, 3, seed=rows), SCHEMA).repartition(5))
    assert max(len(r[7]) for r in got) > 80


def test_pieces_hold_the_repaired_turns(spark, monkeypatch):
    monkeypatch.setattr(conversations, "ROWS", 5)
    rows = [(1, i, ("user", "assistant")[i % 2], f"text {i}.") for i in range(23)] + [(2, 0, "user", "Hm?"), (2, 1, "assistant", "Ah.")]
    pieces = conversations.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "piece").collect()
    assert [(r["conv_id"], r["piece"], r["pieces"]) for r in pieces if r["conv_id"] == 2] == [(2, 0, 1)]
    first = [r for r in pieces if r["conv_id"] == 1]
    assert len(first) >= 5 and {r["pieces"] for r in first} == {len(first)}
    turns = [tuple(t) for r in first for t in r["repaired"]]
    # A user's turn at the end costs as much to answer (2) as anything else; deleting it costs 3.
    assert turns == [(r, t) for _, _, r, t in rows[:23]] + [("assistant", "")]
    assert sum(r["cost"] for r in first) == 2 and "".join(r["audit"] for r in first) == "K" * 23 + "I"


def test_a_conversation_that_only_lost_its_rows(spark):
    lost = next((c, t) for c in range(100) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    got = compare(spark.createDataFrame([(*lost, "user", "Hi.")] * 3, SCHEMA))
    assert got == [(lost[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert conversations.audit_damaged(spark.createDataFrame([], SCHEMA)).count() == 0


def test_counts_per_conversation(spark):
    rows = [(5, 3, "user", "A."), (5, 3, "user", "A."), (5, None, "system", "S."), (5, 9, "assistant", "no end")]
    got = conversations.digests(conversations.repair(spark.createDataFrame(rows, SCHEMA))).first()
    assert (got["gaps"], got["duplicate"], got["truncated"], got["illegal"], got["cost"], got["audit"]) == (5, 1, 1, 1, 4, "KDKK") or \
        (got["audit"], got["cost"]) == ("KKDK", 4)
    assert Counter(got["audit"]) == Counter("KKKD")
