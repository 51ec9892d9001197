"""Weak labels: a generative model of overlapping voters, and a linear model on its posteriors.

A voter says 0 (abstains), 1 (negative) or 2 (positive). The label model has a class prior and, for each
voter and class, the probability of each vote; expectation-maximisation fits them to the counts of
vote patterns, of which there are few however many documents there are.
"""

from __future__ import annotations

import numpy as np


def pattern_codes(votes: np.ndarray) -> np.ndarray:
    """One integer per row of votes (base 3)."""
    return votes.astype(np.int64) @ (3 ** np.arange(votes.shape[1], dtype=np.int64))


def patterns(codes: np.ndarray, voters: int) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(voters, dtype=np.int64) % 3


class LabelModel:
    """Prior, vote probabilities [class, voter, vote], correlations and weights of the voters."""

    def __init__(self, prior: float, table: np.ndarray, correlation: np.ndarray):
        self.prior, self.table, self.correlation = prior, table, correlation
        #: A voter that repeats others counts as its share of them.
        self.weight = 1 / (1 + correlation.sum(axis=1))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(positive) of each row of votes."""
        ratio = np.log(self.table[1]) - np.log(self.table[0])
        odds = np.log(self.prior / (1 - self.prior))
        for j in range(votes.shape[1]):
            odds = odds + self.weight[j] * ratio[j][votes[:, j]]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def accuracies(self) -> np.ndarray:
        """P(vote is right | it votes) of each voter."""
        right = (1 - self.prior) * self.table[0, :, 1] + self.prior * self.table[1, :, 2]
        wrong = (1 - self.prior) * self.table[0, :, 2] + self.prior * self.table[1, :, 1]
        return right / (right + wrong)


def conditional_correlation(votes: np.ndarray, counts: np.ndarray, positive: np.ndarray, least: float = 0.1) -> np.ndarray:
    """Correlation of the voters' votes given the class (mean over the classes, by their weight); 0 below ``least``."""
    value = np.array([0.0, -1.0, 1.0])[votes]
    total = np.zeros((votes.shape[1],) * 2)
    for w in (counts * positive, counts * (1 - positive)):
        share = w.sum() / max(counts.sum(), 1e-300)
        if w.sum() <= 0:
            continue
        x = value - (w @ value) / w.sum()
        cov = (x * w[:, None]).T @ x / w.sum()
        var = np.diag(cov)
        some = var > 1e-4  # a voter that doesn't vary within a class has no correlation there
        std = np.sqrt(np.where(some, var, 1.0))
        total += share * np.where(np.outer(some, some), cov / np.outer(std, std), 0)
    np.fill_diagonal(total, 0)
    return np.where(total >= least, total, 0)


def fit_label_model(votes: np.ndarray, counts: np.ndarray, start: np.ndarray, correlated: bool = False, rounds: int = 100, smoothing: float = 1.0) -> LabelModel:
    """votes: distinct patterns; counts: documents of each; start: first guess of P(positive) of each.
    With ``correlated`` the voters' correlations within a class are estimated from the first guess, rounded,
    and their votes weigh less by them; estimated anew in each round, that would feed on itself."""
    m = votes.shape[1]
    positive, model = start.astype(float), None
    correlation = conditional_correlation(votes, counts, (positive > 0.5).astype(float)) if correlated else np.zeros((m, m))
    for k in range(rounds):
        table = np.full((2, m, 3), smoothing)
        for c, w in enumerate((counts * (1 - positive), counts * positive)):
            for j in range(m):
                table[c, j] += np.bincount(votes[:, j], weights=w, minlength=3)
        table /= table.sum(axis=2, keepdims=True)
        prior = float(np.clip((counts @ positive) / max(counts.sum(), 1), 1e-4, 1 - 1e-4))
        model = LabelModel(prior, table, correlation)
        new = model.posterior(votes)
        if k and np.abs(new - positive).max(initial=0) < 1e-6:
            break
        positive = new
    return model


def fit_linear(starts: np.ndarray, cols: np.ndarray, vals: np.ndarray, y: np.ndarray, size: int, l1: float = 1e-4, l2: float = 1e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """(weights, intercept) of a logistic regression on soft labels by accelerated proximal gradient steps.
    Row i has columns cols[starts[i]:starts[i + 1]] (each once) with values vals."""
    n = len(y)
    if not n:
        return np.zeros(size), 0.0
    row = np.repeat(np.arange(n), np.diff(starts))
    scale = np.sqrt(np.bincount(cols, weights=vals * vals, minlength=size) / n) + 1e-12
    x = vals / scale[cols]

    def product(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=x * w[cols], minlength=n)

    v = np.ones(size) / np.sqrt(size)
    for _ in range(12):  # the largest curvature, by power iteration
        u = np.bincount(cols, weights=x * product(v)[row], minlength=size) / n
        norm = float(np.linalg.norm(u)) or 1.0
        v = u / norm
    step = 1 / (0.25 * (norm * 1.1 + 1) + l2)
    w, b = np.zeros(size), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    look_w, look_b, t = w, b, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(product(look_w) + look_b, -500, 500))) - y
        grad = np.bincount(cols, weights=x * error[row], minlength=size) / n + l2 * look_w
        new = look_w - step * grad
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        new_b = look_b - step * error.mean()
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        look_w, look_b = new + (last - 1) / t * (new - w), new_b + (last - 1) / t * (new_b - b)
        w, b = new, new_b
    return w / scale, b
