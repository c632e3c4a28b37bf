"""A robust-pruned directed graph over the vectors of one shard, for operator 6.

Nearness is the inner product.  For building, each vector gets one more component that makes all
norms equal, so that a larger inner product is a smaller Euclidean distance.  All steps work on many points at once.
"""

from __future__ import annotations

import numpy as np

DEGREE, BEAM, RELAXED, BATCH = 24, 64, 1.2, 512


def levelled(vectors: np.ndarray) -> np.ndarray:
    """Vectors of equal norm whose inner products with (q, 0) are those of the given ones with q."""
    squares = np.einsum("ij,ij->i", vectors, vectors)
    rest = np.sqrt(np.maximum(squares.max() - squares, 0))
    return np.concatenate([vectors, rest[:, None]], axis=1).astype(np.float32)


def entries(n: int, most: int = 48, seed: int = 5) -> np.ndarray:
    """Where searches begin: random points, as edges within a dense cluster may never leave it."""
    return np.random.default_rng(seed).permutation(n)[:most]


def beam_search(points: np.ndarray, graph: np.ndarray, queries: np.ndarray, beam: int):
    """The nearest points found for each query, nearest first, and the points expanded on the way (-1: none).

    All queries advance in step: each expands the nearest point of its beam not yet expanded.
    """
    n, b = len(points), len(queries)
    begin = entries(n, min(48, beam))
    rows = np.arange(b)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True
    ids = np.full((b, beam), n, np.int64)
    near = np.full((b, beam), -np.inf, np.float32)
    done = np.ones((b, beam), bool)
    score = queries @ points[begin].T
    first = np.argsort(-score, axis=1, kind="stable")
    some = slice(0, len(begin))
    ids[:, some], near[:, some], done[:, some] = begin[first], np.take_along_axis(score, first, axis=1), False
    seen[:, begin] = True
    path = []
    while True:
        open_ = ~done
        active = open_.any(axis=1)
        if not active.any():
            break
        who = rows[active]
        at = open_[who].argmax(axis=1)
        node = ids[who, at]
        done[who, at] = True
        step = np.full(b, -1, np.int64)
        step[who] = node
        path.append(step)
        ahead = graph[node]
        fresh = ~seen[who[:, None], ahead]
        seen[who[:, None], ahead] = True
        score = np.einsum("ijk,ik->ij", points[np.minimum(ahead, n - 1)], queries[who])
        score[~fresh] = -np.inf
        # The beam and what was found, best first.
        all_near = np.concatenate([near[who], score], axis=1)
        best = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        ids[who] = np.take_along_axis(np.concatenate([ids[who], ahead], axis=1), best, axis=1)
        near[who] = np.take_along_axis(all_near, best, axis=1)
        done[who] = np.take_along_axis(np.concatenate([done[who], ~fresh], axis=1), best, axis=1)
    return ids, near, np.stack(path, axis=1)


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, relaxed: float, degree: int) -> np.ndarray:
    """Out-neighbours for each point of ``own`` among its candidates (n: none).

    The nearest candidate stays, and every candidate that is nearer to it, by the factor ``relaxed``, than to
    the point goes; and so on with what is left.
    """
    n = len(points)
    candidates = np.sort(candidates, axis=1)
    again = np.zeros(candidates.shape, bool)
    again[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
    alive = (candidates < n) & ~again & (candidates != own[:, None])
    chosen = points[np.minimum(candidates, n - 1)]
    squares = np.einsum("ijk,ijk->ij", chosen, chosen)
    mine = points[own]
    apart = squares + np.einsum("ij,ij->i", mine, mine)[:, None] - 2 * np.einsum("ijk,ik->ij", chosen, mine)
    between = squares[:, :, None] + squares[:, None, :] - 2 * (chosen @ chosen.transpose(0, 2, 1))
    result = np.full((len(own), degree), n, np.int64)
    rows = np.arange(len(own))
    for slot in range(degree):
        if not alive.any():
            break
        nearest = np.where(alive, apart, np.inf).argmin(axis=1)
        some = alive[rows, nearest]
        result[some, slot] = candidates[some, nearest[some]]
        alive[rows, nearest] = False
        alive &= between[rows, nearest] * (relaxed * relaxed) > apart
    return result


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, seed: int = 7) -> np.ndarray:
    """The graph (n rows of out-neighbours, n: none) over different points of equal norm.

    It starts from random edges.  Each of two passes searches for every point in the graph so far, prunes what the
    search expanded to the point's out-neighbours, and adds the edges back, pruned where they are too many.
    """
    n = len(points)
    rng = np.random.default_rng(seed)
    graph = np.full((n, degree), n, np.int64)
    if n <= degree:
        for i in range(n):
            graph[i, : n - 1] = np.delete(np.arange(n), i)
        return graph
    drawn = np.sort(rng.integers(0, n, (n, degree // 2)), axis=1)
    drawn[:, 1:][drawn[:, 1:] == drawn[:, :-1]] = n
    drawn[drawn == np.arange(n)[:, None]] = n
    graph[:, : degree // 2] = drawn
    for relaxed in (1.0, RELAXED):
        order = rng.permutation(n)
        for begin in range(0, n, BATCH):
            batch = order[begin: begin + BATCH]
            _, _, path = beam_search(points, graph, points[batch], beam)
            path[path < 0] = n
            for part in range(0, len(batch), 64):
                own = batch[part: part + 64]
                candidates = np.concatenate([path[part: part + 64], graph[own]], axis=1)
                graph[own] = robust_prune(points, own, candidates, relaxed, degree)
            _add_back(points, graph, batch, relaxed)
    return graph


def _add_back(points: np.ndarray, graph: np.ndarray, batch: np.ndarray, relaxed: float) -> None:
    """Add the edges from each out-neighbour of the batch back to it."""
    n, degree = graph.shape
    to = graph[batch].ravel()
    source = np.repeat(batch, degree)
    source, to = source[to < n], to[to < n]
    order = np.argsort(to, kind="stable")
    source, to = source[order], to[order]
    ends = np.flatnonzero(np.diff(to, append=-1)) + 1
    starts = np.concatenate([[0], ends[:-1]])
    many = []
    for begin, end in zip(starts.tolist(), ends.tolist()):
        point = int(to[begin])
        old = graph[point]
        new = np.setdiff1d(source[begin: end], old)
        free = np.flatnonzero(old == n)
        if len(new) <= len(free):
            graph[point, free[: len(new)]] = new
        else:
            many.append((point, np.concatenate([old[old < n], new])))
    for begin in range(0, len(many), 64):
        part = many[begin: begin + 64]
        width = max(len(c) for _, c in part)
        candidates = np.full((len(part), width), n, np.int64)
        for i, (_, c) in enumerate(part):
            candidates[i, : len(c)] = c
        own = np.array([point for point, _ in part])
        graph[own] = robust_prune(points, own, candidates, relaxed, degree)
