"""Operator 6: approximate nearest neighbours by inner product, over one pruned graph per shard."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import parts_for
from tidemark.llm.graph import DEGREE, beam_search, build, levelled
from tidemark.session import checkpointed

PER_SHARD, PER_BLOCK, SEARCH_BEAM = 4096, 2048, 128
_INDEX = "shard bigint, dim int, n bigint, vectors binary, graph binary, ids binary, starts binary"
_FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vector: Column) -> Column:
    """Vectors that take part: not null or empty, all components finite, one of them not zero."""
    big = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < big), F.lit(False)))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _indexed(rows: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack([np.asarray(v, dtype=np.float64) for v in rows["vector"]])
    ids = rows["vec_id"].to_numpy(np.int64)
    # Equal vectors are one point of the graph, with all their ids in ascending order.
    different, which = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, which.ravel()))
    starts = np.searchsorted(which.ravel()[order], np.arange(len(different) + 1)).astype(np.int64)
    graph = build(levelled(different))
    return pd.DataFrame({
        "shard": [rows["shard"].iloc[0]], "dim": [rows["dim"].iloc[0]], "n": [len(different)],
        "vectors": [different.tobytes()], "graph": [graph.astype(np.int32).tobytes()], "ids": [ids[order].tobytes()],
        "starts": [starts.tobytes()]})


def build_index(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                per_shard: int = PER_SHARD) -> DataFrame:
    """One row per shard: its different vectors, their graph, and the ids of each.  Every usable row is in it."""
    rows = vectors.filter(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    shards = parts_for(rows.count(), per_shard)
    dealt = rows.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), F.size("vector").alias("dim"))
    return checkpointed(dealt.groupBy("shard", "dim").applyInPandas(_indexed, _INDEX), "graphs")


def _searched(k: int, beam: int):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(index) and len(queries):
            one = index.iloc[0]
            n, dim = int(one["n"]), int(one["dim"])
            vectors = np.frombuffer(one["vectors"], np.float64).reshape(n, dim)
            graph = np.frombuffer(one["graph"], np.int32).reshape(n, DEGREE).astype(np.int64)
            ids, starts = np.frombuffer(one["ids"], np.int64), np.frombuffer(one["starts"], np.int64)
            points = levelled(vectors)
            for begin in range(0, len(queries), 512):
                part = queries.iloc[begin: begin + 512]
                asked = np.stack([np.asarray(v, dtype=np.float64) for v in part["vector"]])
                flat = np.concatenate([asked, np.zeros((len(asked), 1))], axis=1).astype(np.float32)
                found, _, _ = beam_search(points, graph, flat, beam)
                for q, vector, hits in zip(part["query_id"].to_numpy(), asked, found):
                    hits = hits[hits < n]
                    exact = vectors[hits] @ vector
                    order = np.argsort(-exact, kind="stable")[: k + 1]
                    # Of equal vectors the k + 1 smallest ids are enough, the query's own among them.
                    names = [ids[starts[h]: min(starts[h] + k + 1, starts[h + 1])] for h in hits[order]]
                    scores = np.repeat(exact[order], [len(x) for x in names])
                    names = np.concatenate(names)
                    other = names != q
                    names, scores = names[other], scores[other]
                    best = np.lexsort((names, -scores))[:k]
                    out.append(pd.DataFrame({"query_id": q, "vec_id": names[best], "score": scores[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.array([], "int64"), "vec_id": pd.array([], "int64"),
                                                        "score": pd.array([], "float64")})

    return run


def search(index: DataFrame, queries: DataFrame, k: int = 20, beam: int = SEARCH_BEAM,
           per_block: int = PER_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the largest inner products found for each query.

    ``queries`` has ``query_id, vector``.  Queries are dealt to blocks, and each block meets each shard of its
    dimension in one task: beam search, then exact scores in double precision.  The query's own id is no
    candidate; ties go to the smaller id.
    """
    blocks = parts_for(queries.count(), per_block)
    shards = index.select("shard", "dim").distinct().groupBy("dim").agg(F.collect_list("shard").alias("shards"))
    asked = (queries.select("query_id", "vector", F.size("vector").alias("dim"),
                            F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"))
             .join(F.broadcast(shards), "dim").withColumn("shard", F.explode("shards")).drop("shards"))
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    key = ["shard", "dim", "block"]
    found = copies.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(_searched(k, beam), _FOUND)
    # A query has k rows from each shard at most.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
            per_shard: int = PER_SHARD, beam: int = SEARCH_BEAM) -> DataFrame:
    """Index all rows and search for those that ``queries`` picks.

    Null, empty and zero vectors and those with a null or non-finite component take no part, nor do rows without an id.
    Vectors meet those of their own length only.  Rows that share an id are all candidates but for that id's
    query, which is asked once, with one of its vectors.  An empty table gives no rows; other columns are ignored.
    """
    index = build_index(vectors, vec_id, vector, per_shard)
    asked = vectors.filter(usable(F.col(vector)) & F.col(vec_id).isNotNull() & queries).groupBy(
        F.col(vec_id).cast("bigint").alias("query_id")).agg(F.min(F.col(vector).cast("array<double>")).alias("vector"))
    return search(index, asked, k, beam)
