"""Connected components of a link table by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import checkpointed


def _least(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), "m")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: the smallest node that each linked node can reach, itself included.

    Each turn joins every node's larger neighbours to its smallest one (large star) and every
    node's smaller neighbours, itself included, to the smallest (small star), until the links
    no longer change; a path of n links takes about log n turns.  Links of a node to itself
    add nothing; null ends are dropped.  Neighbour lists are never gathered: minima are partial
    aggregates, and the joins are plain ones that adaptive execution can split.
    """
    edges = checkpointed(
        links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_least(both), F.col("u") == F.col("_u")).filter("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")))
        starred = checkpointed(large.distinct(), "links")
        small = (starred.join(_least(starred), F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u != v").unionByName(_least(starred).select(F.col("_u").alias("u"), F.col("m").alias("v"))))
        edges = checkpointed(small.distinct(), "links")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
