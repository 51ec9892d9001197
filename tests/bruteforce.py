"""Plain numpy reference implementations for small inputs."""

from __future__ import annotations

import math

import numpy as np


def digamma(x: float) -> float:
    # psi via recurrence + asymptotic series (independent of the Spark helper)
    r = 0.0
    while x < 20:
        r -= 1.0 / x
        x += 1.0
    return r + math.log(x) - 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * x ** 4) - 1 / (252 * x ** 6)


def mi_knn(x: np.ndarray, y: np.ndarray, k: int = 5) -> float:
    """kNN mutual information of continuous x with discrete y, no jitter."""
    n = len(x)
    radius = np.zeros(n)
    k_all = np.zeros(n)
    counts = np.zeros(n)
    for c in np.unique(y):
        idx = np.flatnonzero(y == c)
        counts[idx] = len(idx)
        if len(idx) > 1:
            kk = min(k, len(idx) - 1)
            xc = x[idx]
            for i in idx:
                d = np.sort(np.abs(xc - x[i]))
                radius[i] = d[kk]  # d[0] is the point itself
                k_all[i] = kk
    keep = counts > 1
    x, radius, k_all, counts = x[keep], radius[keep], k_all[keep], counts[keep]
    m = np.array([np.sum(np.abs(x - x[i]) < radius[i]) if radius[i] > 0 else np.sum(x == x[i])
                  for i in range(len(x))])
    nn = len(x)
    val = (digamma(nn) + np.mean([digamma(v) for v in k_all]) - np.mean([digamma(v) for v in counts])
           - np.mean([digamma(v) for v in m]))
    return max(0.0, val)


def average_precision(y, p):
    order = np.argsort(-p, kind="mergesort")
    ys, ps = y[order], p[order]
    ap, tp, fp, prev_r = 0.0, 0, 0, 0.0
    P = ys.sum()
    i = 0
    while i < len(ps):
        j = i
        while j < len(ps) and ps[j] == ps[i]:
            tp += ys[j]
            fp += 1 - ys[j]
            j += 1
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
        i = j
    return ap


def roc_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))
