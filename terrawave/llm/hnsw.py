"""A navigable small-world graph over the vectors of one shard, searched for many queries at once in numpy."""

from __future__ import annotations

import numpy as np

M, WIDTH, BEAM = 12, 24, 32  # links that a new node makes, links that it keeps, nodes that a search expands
BATCH, QUERIES = 256, 256


def _choose(x: np.ndarray, cand: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
    """The m best candidates of each row, those first that are nearer to the row than to a better one chosen (so that links leave dense spots), padded with -1."""
    order = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * m]
    cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
    v = x[cand]
    among = np.einsum("icd,ied->ice", v, v)
    n, c = cand.shape
    chosen = np.zeros((n, c), bool)
    for j in range(c):
        near = np.where(chosen, among[:, j, :], -2).max(axis=1)
        chosen[:, j] = (sims[:, j] > near) & (chosen.sum(axis=1) < m) & np.isfinite(sims[:, j])
    rank = np.where(chosen, 0, 1) * 4.0 - np.where(np.isfinite(sims), sims, -10)
    keep = np.argsort(rank, axis=1, kind="stable")[:, :m]
    out = np.take_along_axis(cand, keep, 1)
    return np.where(np.isfinite(np.take_along_axis(sims, keep, 1)), out, -1).astype(np.int32)


def _search(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int, until: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """The 2 * beam nodes nearest to each query, and their similarities, of those that a best-first search met; -1 and -inf where there are fewer. It expands `beam` nodes, and further ones while they are at least `until` similar."""
    width = 2 * beam
    met = np.zeros((len(q), len(x)), bool)
    node, sims = np.full((len(q), width), -1, np.int32), np.full((len(q), width), -np.inf, np.float32)
    done = np.zeros((len(q), width), bool)
    k = min(entry.shape[1], width)
    node[:, :k], sims[:, :k] = entry[:, :k], np.einsum("qed,qd->qe", x[entry[:, :k]], q)
    np.put_along_axis(met, entry[:, :k], True, 1)
    live = np.arange(len(q))
    for step in range(4 * beam + 1):
        left = np.where(done[live], -np.inf, sims[live])
        best = left.argmax(axis=1)
        value = left[np.arange(len(live)), best]
        go = np.isfinite(value) & ((step < beam) | (value >= until))
        live, best = live[go], best[go]
        if not len(live):
            break
        done[live, best] = True
        at = node[live, best]
        near = links[at]
        near = np.where(near < 0, at[:, None], near)
        i, j = np.nonzero(~met[live[:, None], near])
        if not len(i):
            continue
        found = near[i, j]
        met[live[i], found] = True
        more = np.full(near.shape, -np.inf, np.float32)
        more[i, j] = np.einsum("kd,kd->k", x[found], q[live[i]])
        every = np.concatenate([sims[live], more], axis=1)
        keep = np.argpartition(-every, width - 1, axis=1)[:, :width]
        sims[live] = np.take_along_axis(every, keep, 1)
        node[live] = np.take_along_axis(np.concatenate([node[live], near], axis=1), keep, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros(near.shape, bool)], axis=1), keep, 1)
    node[~np.isfinite(sims)] = -1
    return node, sims


def _layer(x: np.ndarray) -> np.ndarray:
    """Links [node, WIDTH] of a layer, nodes added in batches."""
    n = len(x)
    links = np.full((n, WIDTH), -1, np.int32)
    done = 0
    while done < n:
        size = min(max(done, 64), BATCH, n - done)
        new = np.arange(done, done + size)
        inner = x[new] @ x[new].T
        np.fill_diagonal(inner, -np.inf)
        if done:
            entry = np.tile(np.linspace(0, done - 1, min(4, done)).astype(np.int64), (size, 1))
            node, sims = _search(x[:done], links[:done], x[new], entry, BEAM)
            node, sims = np.concatenate([node, np.tile(new, (size, 1))], axis=1), np.concatenate([sims, inner], axis=1)
        else:
            node, sims = np.tile(new, (size, 1)), inner
        k = min(2 * M, sims.shape[1])
        at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        cand = np.maximum(np.take_along_axis(node, at, 1), 0)
        links[new, :M] = _choose(x, cand, np.take_along_axis(sims, at, 1), M)[:, :M] if k >= M else np.pad(_choose(x, cand, np.take_along_axis(sims, at, 1), k), ((0, 0), (0, M - k)), constant_values=-1)
        # The nodes that were linked to link back.
        a, b = np.repeat(new, M), links[new, :M].ravel()
        a, b = a[b >= 0], b[b >= 0]
        order = np.argsort(b, kind="stable")
        a, b = a[order], b[order]
        nodes, start, count = np.unique(b, return_index=True, return_counts=True)
        extra = int(min(count.max(initial=0), WIDTH))
        both = np.full((len(nodes), WIDTH + extra), -1, np.int64)
        both[:, :WIDTH] = links[nodes]
        for i in range(extra):
            has = count > i
            both[has, WIDTH + i] = a[start[has] + i]
        value = np.einsum("kcd,kd->kc", x[np.maximum(both, 0)], x[nodes])
        value[both < 0] = -np.inf
        ordered = np.sort(both, axis=1)
        twice = np.zeros_like(both, bool)
        twice[np.arange(len(nodes))[:, None], np.argsort(both, axis=1, kind="stable")] = np.concatenate([np.zeros((len(nodes), 1), bool), ordered[:, 1:] == ordered[:, :-1]], axis=1)
        value[twice] = -np.inf
        links[nodes] = _choose(x, np.maximum(both, 0), value, WIDTH)
        done += size
    return links


def build(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers (members, links between their positions), the whole shard first; each next layer holds every M-th node of the one before. x: unit vectors in an order that has nothing to do with their places."""
    layers, members = [], np.arange(len(x))
    while True:
        layers.append((members, _layer(x[members])))
        if len(members) <= 2 * M:
            return layers
        members = members[::M]


def within(x: np.ndarray, layers: list, q: np.ndarray, least: float, beam: int) -> np.ndarray:
    """bool [query, node], queries few enough for that: nodes found with a cosine of `least` or more. A query that finds `beam` such nodes is compared with the whole shard."""
    members, _ = layers[-1]
    entry = np.argsort(-(q @ x[members].T), axis=1)[:, :4]
    for level in range(len(layers) - 1, -1, -1):
        members, links = layers[level]
        if level < len(layers) - 1:
            entry = entry * M
        node, sims = _search(x[members] if level else x, links, q, entry, beam if level == 0 else 8, least if level == 0 else 2.0)
        if level:
            order = np.argsort(-sims, axis=1)[:, : min(4, len(members))]
            entry = np.take_along_axis(node, order, 1)
            entry = np.where(entry < 0, entry[:, :1], entry)
    near = sims >= least - 1e-6
    found = np.zeros((len(q), len(x)), bool)
    i, j = np.nonzero(near)
    found[i, node[i, j]] = True
    many = near.sum(axis=1) >= beam
    if many.any():
        found[many] = q[many] @ x.T >= least - 1e-6
    return found
