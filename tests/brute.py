"""Independent NumPy implementations used as brute-force oracles in tests.

Straight loops over points in a fixed order; distances are summed coordinate by
coordinate from zero, the same order the Spark expressions use.
"""

from __future__ import annotations

import math

import numpy as np


def dist(a, b) -> float:
    acc = 0.0
    for p, q in zip(a, b):
        acc += (p - q) * (p - q)
    return math.sqrt(acc)


def dist_matrix(P) -> np.ndarray:
    P = np.asarray(P, dtype=float)
    acc = np.zeros((len(P), len(P)))
    for d in range(P.shape[1]):
        diff = P[:, d, None] - P[None, :, d]
        acc += diff * diff
    return np.sqrt(acc)


def fft(points, m):
    """points: list of (point_id, x) sorted by id. Returns [(pos, point_id, weight, rho)]."""
    ids = [p[0] for p in points]
    X = [p[1] for p in points]
    n = len(X)
    md = [math.inf] * n
    chosen = [0]
    for _ in range(1, m):
        last = X[chosen[-1]]
        best, best_d = None, 0.0
        for i in range(n):
            d = dist(X[i], last)
            if d < md[i]:
                md[i] = d
            if md[i] > best_d:
                best_d, best = md[i], i
        if best is None:
            break
        chosen.append(best)
    weights = [0] * len(chosen)
    rho = [0.0] * len(chosen)
    for i in range(n):
        ds = [dist(X[i], X[c]) for c in chosen]
        j = min(range(len(ds)), key=lambda t: (ds[t], t))
        weights[j] += 1
        rho[j] = max(rho[j], ds[j])
    return [(pos, ids[c], weights[pos], rho[pos]) for pos, c in enumerate(chosen)]


def initial_radius(X, m):
    m = min(m, len(X))
    ds = [dist(X[i], X[j]) for i in range(m) for j in range(i + 1, m)]
    return (min(ds) / 2) if ds else 0.0


def weighted_greedy(X, W, k, z, alpha, r0=None):
    """Sequential weighted greedy; returns (center indices, r, guesses)."""
    n = len(X)
    D = dist_matrix(X)
    r = initial_radius(X, k + z + 1) if r0 is None else r0
    guesses = 1
    while True:
        unc = [True] * n
        S = []
        wz = sum(W)
        Wv = np.asarray(W, dtype=float)
        while len(S) < k and wz > 0:
            # ball weight of every candidate; argmax keeps the first (lowest index) maximum
            bws = (D <= (1 + 2 * alpha) * r).astype(float) @ (Wv * np.asarray(unc, dtype=float))
            best = int(np.argmax(bws)) if bws.max() > 0 else 0
            S.append(best)
            for j in range(n):
                if unc[j] and D[best, j] <= (3 + 4 * alpha) * r:
                    unc[j] = False
                    wz -= W[j]
        if wz <= z:
            return S, r, guesses
        r *= 2
        guesses += 1


def objective(X, C, z):
    ds = sorted((min(dist(x, c) for c in C) for x in X), reverse=True)
    return ds[z]


def uncovered_after(X, W, k, z, alpha, r):
    """Run one guess of the weighted greedy at radius r; return the uncovered weight."""
    n = len(X)
    D = dist_matrix(X)
    unc = np.ones(n, dtype=bool)
    Wv = np.asarray(W, dtype=float)
    S = []
    while len(S) < k and Wv[unc].sum() > 0:
        bws = (D <= (1 + 2 * alpha) * r).astype(float) @ (Wv * unc)
        best = int(np.argmax(bws)) if bws.max() > 0 else 0
        S.append(best)
        unc &= ~(D[best] <= (3 + 4 * alpha) * r)
    return int(Wv[unc].sum())
