"""Connected components of records that share keys, without pairing the records of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import checkpointed


def _with_least(edges: DataFrame) -> DataFrame:
    """``u, v, m``: edges with the least neighbour of ``u``.

    The list of minima is written before it is joined, so both sides of the join are plain shuffles and a hub's edges can
    be split.
    """
    least = checkpointed(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    return edges.join(least, "u")


def _tied_to_least(edges: DataFrame) -> DataFrame:
    """``u, v``: every node of the written ``edges`` (u, v; v smaller) with the least one it is linked to, that one left out.

    Every node's larger neighbours are tied to its least one, and its smaller ones likewise, in turn, until no edge changes;
    chains of n nodes take about log n turns.
    """
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            return edges
        before = state
        both = checkpointed(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both-ways")
        # A node stands in for its least neighbour only if that one is smaller.
        larger = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        larger = checkpointed(larger.distinct(), "edges")
        smaller = _with_least(larger)
        edges = checkpointed(smaller.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            smaller.select("u", F.col("m").alias("v"))).distinct(), "edges")


def components_of_keys(members: DataFrame, record: str, key: str) -> DataFrame:
    """``record, component``: every record with the least record that shared keys lead to, itself included.

    ``members`` holds (record, key) rows; a null key joins nothing, a null record is left out.  Records lie at their
    least key, and only keys are tied to each other, by the records that have several; records with one key, most
    of them as a rule, take no part in the turns.  Nothing is gathered per key, per record or per component.
    """
    rows = checkpointed(members.select(F.col(record).alias("v"), F.col(key).alias("u")).filter("v is not null"), "members")
    homes = checkpointed(rows.groupBy("v").agg(F.min("u").alias("home"), (F.min("u") != F.max("u")).alias("several")), "homes")
    tied = rows.join(homes.filter("several").drop("several"), "v").filter("u != home").select("u", F.col("home").alias("v"))
    roots = _tied_to_least(checkpointed(tied.distinct(), "edges")).withColumnsRenamed({"u": "home", "v": "_root"})
    housed = homes.filter("home is not null")
    # The least record at each key, then of all keys that are linked.
    least = housed.groupBy("home").agg(F.min("v").alias("_least"))
    keys = checkpointed(least.join(roots, "home", "left").select(
        "home", "_least", F.coalesce("_root", "home").alias("_root")), "keys")
    ends = checkpointed(keys.groupBy("_root").agg(F.min("_least").alias("component")), "ends")
    found = checkpointed(keys.join(ends, "_root").select("home", "component"), "found")
    return housed.join(found, "home").select(F.col("v").alias(record), "component").unionByName(
        homes.filter("home is null").select(F.col("v").alias(record), F.col("v").alias("component")))
