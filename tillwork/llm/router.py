"""Partitions of a neighbour graph and a classifier that finds them, for vectors."""

from __future__ import annotations

import numpy as np


def neighbours(vectors: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest others of each vector, by Euclidean distance."""
    n = len(vectors)
    k = min(k, n - 1)
    norms = (vectors**2).sum(axis=1)
    out = np.empty((n, k), np.int64)
    for start in range(0, n, 1024):
        block = vectors[start : start + 1024]
        far = norms[None, :] - 2 * block @ vectors.T
        far[np.arange(len(block)), start + np.arange(len(block))] = np.inf
        out[start : start + 1024] = np.argpartition(far, k - 1, axis=1)[:, :k] if k else 0
    return out


def _halves(vectors: np.ndarray, inside: np.ndarray, graph: np.ndarray, rounds: int) -> np.ndarray:
    """Cuts some vectors into two equal halves with few edges between them.

    They are first cut at the median of their main direction; then the same number from
    each side change over, those first that have most of their neighbours there.
    """
    own = vectors[inside] - vectors[inside].mean(axis=0)
    direction = np.linalg.svd(own.T @ own)[0][:, 0]
    side = np.zeros(len(inside), bool)
    side[np.argsort(own @ direction, kind="stable")[len(inside) // 2 :]] = True
    place = np.full(len(vectors), -1)
    place[inside] = np.arange(len(inside))
    to = place[graph[inside]]
    a = np.repeat(np.arange(len(inside)), to.shape[1])[to.ravel() >= 0]
    b = to.ravel()[to.ravel() >= 0]
    a, b = np.r_[a, b], np.r_[b, a]
    for _ in range(rounds):
        differs = side[a] != side[b]
        gain = np.bincount(a, np.where(differs, 1.0, -1.0), len(inside))
        left = np.flatnonzero(~side)
        right = np.flatnonzero(side)
        left = left[np.argsort(-gain[left], kind="stable")]
        right = right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right))
        good = int((gain[left[:m]] + gain[right[:m]] > 0).sum())
        if not good:
            break
        move = max(1, good // 2)
        side[left[:move]], side[right[:move]] = True, False
    return side


def partition(vectors: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 30) -> np.ndarray:
    """Balanced parts of the neighbour graph, ``parts`` (a power of two) in number."""
    part = np.zeros(len(vectors), np.int64)
    size = parts
    while size > 1:
        size //= 2
        for p in np.unique(part):
            inside = np.flatnonzero(part == p)
            if len(inside) > 1:
                part[inside[_halves(vectors, inside, graph, rounds)]] += size
    return part


class Router:
    """A network of one hidden layer from a vector to the parts its neighbours lie in."""

    def __init__(self, vectors: np.ndarray, parts: int, seed: int = 1, hidden: int = 128):
        draw = np.random.default_rng(seed)
        self.middle = vectors.mean(axis=0)
        self.scale = max(float(np.sqrt(((vectors - self.middle) ** 2).mean())), 1e-30)
        dim = vectors.shape[1]
        self.weights = [
            draw.normal(0, np.sqrt(2 / dim), (dim, hidden)),
            np.zeros(hidden),
            draw.normal(0, np.sqrt(1 / hidden), (hidden, parts)),
            np.zeros(parts),
        ]

    def _layers(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b, c, d = self.weights
        x = (vectors - self.middle) / self.scale
        h = np.maximum(x @ a + b, 0)
        return x, h, h @ c + d

    def odds(self, vectors: np.ndarray) -> np.ndarray:
        return self._layers(vectors)[2]

    def learn(self, vectors: np.ndarray, target: np.ndarray, epochs: int = 40, seed: int = 2):
        """Fits the shares of parts in ``target`` by Adam on the cross entropy."""
        draw = np.random.default_rng(seed)
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step = 0
        for epoch in range(epochs):
            rate = 3e-3 * (1 - epoch / epochs)
            order = draw.permutation(len(vectors))
            for start in range(0, len(order), 128):
                at = order[start : start + 128]
                x, h, odds = self._layers(vectors[at])
                odds = np.exp(odds - odds.max(axis=1, keepdims=True))
                slope = (odds / odds.sum(axis=1, keepdims=True) - target[at]) / len(at)
                back = (slope @ self.weights[2].T) * (h > 0)
                grads = [x.T @ back, back.sum(axis=0), h.T @ slope, slope.sum(axis=0)]
                step += 1
                for w, g, m, v in zip(self.weights, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self


def _shares(odds: np.ndarray) -> np.ndarray:
    shares = np.exp(odds - odds.max(axis=1, keepdims=True))
    return shares / shares.sum(axis=1, keepdims=True)


def ahead(odds: np.ndarray) -> np.ndarray:
    """For each vector and part, the share of all parts that are more probable."""
    shares = _shares(odds)
    order = np.argsort(-shares, axis=1, kind="stable")
    ranked = np.take_along_axis(shares, order, axis=1)
    before = np.cumsum(ranked, axis=1) - ranked
    out = np.empty_like(before)
    np.put_along_axis(out, order, before, axis=1)
    return out


def fit(
    vectors: np.ndarray, parts: int, recall: float, k: int = 10, tests: int = 512
) -> tuple[Router, float]:
    """Learns to route from a sample, and how far to go down the list of parts.

    Some of the sample are kept out; going down until that share of probability is
    reached finds ``recall`` of their ``k`` nearest in the rest.
    """
    if parts < 2:
        return Router(vectors, 1), 2.0
    order = np.random.default_rng(0).permutation(len(vectors))
    tests = min(tests, len(vectors) // 8)
    probes, known = vectors[order[:tests]], vectors[order[tests:]]
    graph = neighbours(known, 16)
    part = partition(known, graph, parts)
    target = np.zeros((len(known), parts))
    np.add.at(target, (np.repeat(np.arange(len(known)), graph.shape[1]), part[graph].ravel()), 1)
    target[np.arange(len(known)), part] += 4
    router = Router(known, parts).learn(known, target / target.sum(axis=1, keepdims=True))
    lies = router.odds(known).argmax(axis=1)
    far = (known**2).sum(axis=1)[None, :] - 2 * probes @ known.T
    nearest = np.argpartition(far, min(k, len(known) - 1), axis=1)[:, :k]
    needed = np.take_along_axis(ahead(router.odds(probes)), lies[nearest], axis=1)
    return router, float(np.quantile(needed, recall)) + 1e-9
