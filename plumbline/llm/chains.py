"""Stationary distributions of chains given by their rates, in memory, by aggregation and disaggregation.

Items are gathered in clusters with their most strongly tied neighbours, clusters in larger ones, until a chain is
small enough to be squared. A cycle smooths each level, solves the clusters' chain, whose rates follow from
the items' present shares, gives its shares back to the items, and smooths again. Cycles are mixed so that
they move least. So chains that mix slowly, as of items that meet only neighbours in a long row, converge too."""

from __future__ import annotations

import numpy as np

#: Items of a chain that is squared.
SQUARED = 300
DAMPING = 0.7


def mixing_shares(gram: np.ndarray) -> np.ndarray:
    """Shares, adding up to 1, of steps whose mix moves least, from the products of their moves."""
    n = len(gram)
    scale = np.sqrt(np.diag(gram))
    last = np.eye(n)[0]
    if not scale.all():
        return last
    x = np.linalg.solve(gram / np.outer(scale, scale) + 1e-12 * np.eye(n), 1 / scale) / scale
    x = x / x.sum()
    return x if np.isfinite(x).all() and np.abs(x).sum() < 1e4 else last


def _squared(i: np.ndarray, j: np.ndarray, w: np.ndarray, n: int, y: np.ndarray) -> np.ndarray:
    """The chain's distribution after 2^64 steps from ``y``."""
    moves = np.zeros((n, n))
    np.add.at(moves, (i, j), w)
    moves /= max(2 * moves.sum(1).max(initial=0.0), 1e-300)
    moves[np.diag_indices(n)] += 1 - moves.sum(1)
    for _ in range(64):
        y, moves = y @ moves, moves @ moves
        moves /= moves.sum(1, keepdims=True)
    return y


def _clusters(i: np.ndarray, j: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the clusters that form where every item points to the neighbour it is tied to most."""
    a, b, s = np.r_[i, j], np.r_[j, i], np.r_[w, w]
    order = np.lexsort((b, -s, a))
    a, b = a[order], b[order]
    to = np.arange(n)
    head = np.r_[True, a[1:] != a[:-1]] if len(a) else np.zeros(0, bool)
    to[a[head]] = b[head]
    mutual = (to[to] == np.arange(n)) & (np.arange(n) < to)
    to[mutual] = np.flatnonzero(mutual)
    while (to[to] != to).any():
        further = to[to]
        if (further[further] == to).all():
            break
        to = further
    return np.unique(to, return_inverse=True)[1]


class _Levels:
    def __init__(self, i: np.ndarray, j: np.ndarray, w: np.ndarray, n: int):
        self.levels = []
        while n > SQUARED:
            cluster = _clusters(i, j, w, n)
            m = int(cluster.max()) + 1
            if m > 0.9 * n:
                break
            between = cluster[i] != cluster[j]
            key, at = np.unique(cluster[i][between].astype(np.int64) * m + cluster[j][between], return_inverse=True)
            self.levels.append((i, j, n, cluster, m, between, at, key // m))
            i, j, w, n = key // m, key % m, np.bincount(at, w[between], len(key)), m
        self.last = (i, j, n)

    def cycle(self, w: np.ndarray, y: np.ndarray, k: int = 0) -> np.ndarray:
        if k == len(self.levels):
            i, j, n = self.last
            return _squared(i, j, w, n, y) if n <= 2 * SQUARED else _smooth(i, j, n, w, y, 50)
        i, j, n, cluster, m, between, at, start = self.levels[k]
        for _ in range(2 if k else 1):  # levels below the first are a third as large or less
            y = _smooth(i, j, n, w, y, 2)
            whole = np.bincount(cluster, y, m)
            flow = np.bincount(at, (y[i] * w)[between], len(start))
            told = self.cycle(flow / np.maximum(whole[start], 1e-300), whole, k + 1)
            y = _smooth(i, j, n, w, y * (told / np.maximum(whole, 1e-300))[cluster], 2)
        return y


def _smooth(i: np.ndarray, j: np.ndarray, n: int, w: np.ndarray, y: np.ndarray, times: int) -> np.ndarray:
    out = np.bincount(i, w, n)
    for _ in range(times):
        balanced = np.where(out > 0, np.bincount(j, y[i] * w, n) / np.maximum(out, 1e-300), y)
        y = (1 - DAMPING) * y + DAMPING * balanced
    return y


def _parts(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest item that each is linked with."""
    label = np.arange(n)
    while True:
        near = label.copy()
        np.minimum.at(near, i, label[j])
        np.minimum.at(near, j, label[i])
        near = near[near]
        if (near == label).all():
            return label
        label = near


def stationary(i: np.ndarray, j: np.ndarray, r: np.ndarray, n: int, tolerance: float, cycles: int, history: int = 3) -> np.ndarray:
    """Probabilities of n items of which i moves to j at the rate r, every item at some rate to another. Parts
    without moves between them have their share of the items. Raises if a step of the chain of jumps still
    moves more than ``tolerance`` of the probability after ``cycles``."""
    out = np.bincount(i, r, n)
    w = r / out[i]
    levels, y, told, moves, least = _Levels(i, j, w, n), out / out.sum(), [], [], np.inf
    for _ in range(cycles):
        done = levels.cycle(w, y)
        done /= done.sum()
        moved = np.abs(np.bincount(j, done[i] * w, n) - done).sum()
        if moved < tolerance:
            break
        if moved > 2 * least:  # mixing led astray: begin anew
            told, moves = [], []
        least = min(least, moved)
        told, moves = [done, *told][:history], [done - y, *moves][:history]
        shares = mixing_shares(np.array([[a @ b for b in moves] for a in moves]))
        mixed = sum(s * x for s, x in zip(shares, told))
        y = mixed if (mixed > 0).all() else done
    else:
        raise RuntimeError(f"the strengths of {n} items still move by {moved} after {cycles} cycles")
    p, part = done / out, _parts(i, j, n)
    return p / np.bincount(part, p, n)[part] * np.bincount(part, minlength=n)[part] / n
