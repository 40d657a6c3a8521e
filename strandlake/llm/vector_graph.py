"""A flat graph over unit vectors with robust-pruned edges, and greedy search in it for many queries at once (arrays of one shard)."""

from __future__ import annotations

import numpy as np

#: Edges of a node, nodes that a search keeps, and by how much a longer edge must be shorter than the way round to be kept.
DEGREE, BEAM, ALPHA = 16, 24, 1.2
BLOCK = 256


def medoid(x: np.ndarray) -> int:
    """The row nearest to the mean."""
    return int((x @ x.mean(0)).argmax())


def greedy(x: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """For each query (a vector) the beam nearest nodes found and the nodes that were expanded on the way, -1 where there are none.

    Every step expands, for all queries that are still on their way, the nearest node in the beam not yet expanded.
    """
    q, width = len(queries), beam + edges.shape[1]
    seen = np.zeros((q, len(x)), bool)
    seen[:, start] = True
    found_ids, found_near = np.full((q, beam), -1), np.full((q, beam), -np.inf, "f4")
    # Of the queries on their way: places of those kept so far, then of those just met; what is expanded or empty is not open.
    live = np.arange(q)
    ids, near, open_ = np.full((q, width), -1), np.full((q, width), -np.inf, "f4"), np.zeros((q, width), bool)
    ids[:, 0], near[:, 0], open_[:, 0] = start, queries @ x[start], True
    visited = []
    while len(live):
        at = np.where(open_[:, :beam], near[:, :beam], -np.inf).argmax(1)
        rows = np.arange(len(live))
        node = ids[rows, at]
        open_[rows, at] = False
        step = np.full(q, -1)
        step[live] = node
        visited.append(step)
        found = edges[node]
        flat = live[:, None] * len(x) + found
        fresh = (found >= 0) & ~seen.ravel()[flat]
        seen.ravel()[flat[fresh]] = True
        ids[:, beam:], open_[:, beam:] = found, fresh
        near[:, beam:] = np.where(fresh, np.matmul(x[found], queries[live][:, :, None])[:, :, 0], -np.inf)
        best = np.argpartition(-near, beam - 1, axis=1)[:, :beam] + width * rows[:, None]
        ids[:, :beam], near[:, :beam], open_[:, :beam] = ids.ravel()[best], near.ravel()[best], open_.ravel()[best]
        on = open_[:, :beam].any(1)
        if not on.all():
            found_ids[live[~on]], found_near[live[~on]] = ids[~on, :beam], near[~on, :beam]
            live, ids, near, open_ = live[on], ids[on], near[on], open_[on]
    found_ids[found_near == -np.inf] = -1
    return found_ids, np.stack(visited, 1) if visited else np.zeros((q, 0), "i8")


def pruned(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node up to degree of its candidates (-1: none), nearest first, without those that a chosen one is much nearer to."""
    out = np.full((len(nodes), degree), -1)
    for i in range(0, len(nodes), BLOCK):
        own, cand = nodes[i : i + BLOCK], np.sort(candidates[i : i + BLOCK], axis=1)
        repeated = np.zeros(cand.shape, bool)
        repeated[:, 1:] = cand[:, 1:] == cand[:, :-1]
        vectors = x[cand]
        far = 2 - 2 * np.matmul(vectors, x[own][:, :, None])[:, :, 0]
        left = np.where((cand < 0) | repeated | (cand == own[:, None]), np.inf, np.maximum(far, 0))
        rows = np.arange(len(own))
        for r in range(degree):
            at = left.argmin(1)
            there = left[rows, at] < np.inf
            if not there.any():
                break
            out[i + rows[there], r] = cand[rows, at][there]
            between = 2 - 2 * np.matmul(vectors, vectors[rows, at][:, :, None])[:, :, 0]
            left[alpha**2 * between <= far] = np.inf
            left[rows, at] = np.inf
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 7) -> np.ndarray:
    """Edges of each row of x (-1: none): rows are inserted in growing batches, each searched for in the graph so far; edges go both ways."""
    n, start = len(x), medoid(x)
    edges = np.full((n, degree), -1)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    done = 1
    while done < n:
        new = order[done : done + min(done, BLOCK)]
        ids, visited = greedy(x, edges, start, x[new], beam)
        among = x[new] @ x[new].T
        np.fill_diagonal(among, -np.inf)
        k = min(degree, len(new) - 1)
        mates = new[np.argpartition(-among, k - 1, axis=1)[:, :k]] if k else np.zeros((len(new), 0), "i8")
        edges[new] = pruned(x, new, np.concatenate([ids, visited, mates], 1), degree, alpha)
        source, target = np.repeat(new, degree), edges[new].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, first, many = np.unique(target, return_index=True, return_counts=True)
        more = np.full((len(nodes), int(many.max(initial=0))), -1)
        more[np.repeat(np.arange(len(nodes)), many), np.arange(len(target)) - np.repeat(first, many)] = source
        edges[nodes] = pruned(x, nodes, np.concatenate([edges[nodes], more], 1), degree, alpha)
        done += len(new)
    return edges
