from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import identity
from tidemark.operators.components import components_of_keys

RECORD = "system string, external_id string, email string, account_id string"


def _brute(records, shared, by_domain=True):
    """Union-find over all keys of all records."""
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    names = set()
    for system, external, email, account in records:
        if system is None or external is None:
            continue
        name = f"{system}:{external}"
        names.add(name)
        mail = (email or "").strip().lower()
        parts = mail.rsplit("@", 1)
        domain = parts[1] if len(parts) == 2 and all(parts) and not any(ch.isspace() for ch in mail) else None
        keys = [("a", account)] if account is not None else []
        keys += [("e", mail)] if mail else []
        keys += [("d", domain)] if by_domain and domain and domain not in shared else []
        find(("r", name))
        for key in keys:
            root[find(("r", name))] = find(key)
    groups = {}
    for name in names:
        groups.setdefault(find(("r", name)), []).append(name)
    return sorted((*n.split(":", 1), min(g)) for g in groups.values() for n in g)


@pytest.mark.parametrize("by_domain", [True, False])
def test_components_equal_union_find(spark, rows, by_domain):
    rng = random.Random(11)
    mails = [f" U{k}@C{k % 13}.example " if k % 3 else f"u{k}@gmail.com" for k in range(60)] + [None, "", "no at", "@x.example", "a@", "a@b@c.example"]
    records = [(rng.choice(identity.SYSTEMS), f"id:{rng.randrange(90)}", rng.choice(mails) if rng.random() < 0.4 else None,
                f"acc{rng.randrange(70)}" if rng.random() < 0.5 else None) for _ in range(170)]
    records += [("crm", None, "u1@c1.example", "acc1"), (None, "x", "u1@c1.example", "acc1"), records[0], records[0]]
    df = spark.createDataFrame(records, RECORD).withColumn("component", F.lit("clash"))
    expected = [tuple(r) for r in _brute(records, identity.SHARED_DOMAINS, by_domain)]
    assert len({r[2] for r in expected}) > 3
    assert rows(identity.identity_components(df, by_domain=by_domain)) == sorted(expected)
    shared = spark.createDataFrame([("C1.example",), (None,), ("c1.example ",)], "domain string")
    assert rows(identity.identity_components(df, shared, by_domain)) == sorted(
        tuple(r) for r in _brute(records, {"c1.example"}, by_domain))


def test_three_systems_link_over_several_steps(spark):
    records = [("crm", "A", None, "A"), ("billing", "c1", "x@one.example", "A"), ("marketing", "m1", "X@ONE.example", None),
               ("marketing", "m2", "y@one.example", None), ("billing", "c2", "y@gmail.com", None), ("product", "u", None, "A"),
               ("marketing", "m3", "z@gmail.com", None)]
    found = {f"{r.system}:{r.external_id}": r.identity_id for r in identity.identity_components(
        spark.createDataFrame(records, RECORD)).collect()}
    together = {"crm:A", "billing:c1", "marketing:m1", "marketing:m2", "product:u"}
    assert {k for k, v in found.items() if v == "billing:c1"} == together
    assert found["billing:c2"] == "billing:c2" and found["marketing:m3"] == "marketing:m3"
    sizes = identity.identity_sizes(identity.identity_components(spark.createDataFrame(records, RECORD)))
    assert {tuple(r) for r in sizes.collect()} == {("billing:c1", 1, 1, 2, 1, False), ("billing:c2", 0, 1, 0, 0, False),
                                                   ("marketing:m3", 0, 0, 1, 0, False)}


def test_long_chains_and_a_crowded_domain(spark):
    chain = spark.range(3000).select(F.explode(F.array(
        F.struct(F.format_string("r%05d", "id").alias("r"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("k")),
        F.struct(F.format_string("r%05d", F.col("id") + 1).alias("r"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("k")))).alias("x"))
    found = components_of_keys(chain.select("x.*"), "r", "k")
    assert found.count() == 3001 and [r[0] for r in found.select("component").distinct().collect()] == ["r00000"]
    crowd = spark.range(10000).select(
        F.lit("marketing").alias("system"), F.col("id").cast("string").alias("external_id"),
        F.concat(F.lit("p"), F.col("id").cast("string"), F.lit("@big.example")).alias("email"),
        F.lit(None).cast("string").alias("account_id"))
    found = identity.identity_components(crowd)
    assert found.count() == 10000 and [r[0] for r in found.select("identity_id").distinct().collect()] == ["marketing:0"]


def test_nothing_to_link(spark):
    empty = spark.createDataFrame([], RECORD)
    assert identity.identity_components(empty).count() == 0
    alone = spark.createDataFrame([("crm", "1", None, None), ("crm", "2", None, None)], RECORD)
    assert {r.identity_id for r in identity.identity_components(alone).collect()} == {"crm:1", "crm:2"}


def test_only_keys_take_part_in_the_turns(spark, tmp_path, monkeypatch):
    """Records with one key are tied to nothing; those with several tie their keys, whatever number of rows they come in."""
    written = []

    def noted(df, purpose):
        df.write.parquet(str(tmp_path / f"{len(written)}-{purpose}"))
        written.append((purpose, spark.read.schema(df.schema).parquet(str(tmp_path / f"{len(written)}-{purpose}"))))
        return written[-1][1]

    monkeypatch.setattr("tidemark.operators.components.checkpointed", noted)
    members = [(f"one{i}", f"k{i % 7}") for i in range(700)] + [("a", "k1"), ("a", "k2"), ("a", "k6"), ("a", "k2"), ("b", "k4"),
               ("b", "k5"), ("b", None), ("none", None), (None, "k0")]
    found = {r.r: r.component for r in components_of_keys(spark.createDataFrame(members, "r string, k string"), "r", "k").collect()}
    assert {found[f"one{i}"] for i in (1, 2, 6)} | {found["a"]} == {"a"} and {found["b"], found["one4"], found["one5"]} == {"b"}
    assert found["none"] == "none" and found["one7"] == "one0" and found["one3"] == "one10" and len(found) == 703
    assert max(df.count() for purpose, df in written if purpose == "edges") <= 7
