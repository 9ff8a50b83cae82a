"""A generative model of binary voters and a linear classifier, in numpy, over bounded tables on the driver."""

from __future__ import annotations

import numpy as np


class LabelModel:
    """Latent labels behind voters: a prior, each voter's rates under either label, and the voters' correlations.

    fit() takes the distinct patterns of votes with their counts. Labels given for some rows (1 or 0, -1 for none) pin
    those rows' posteriors to all but `noise`. Expectation maximisation treats voters as independent given the label;
    the correlations that remain within the labels are measured after each round, and a voter's say is divided by one
    plus the sum of its positive correlations, so that copies of a voter don't count twice.
    """

    def __init__(self, rounds: int = 30, noise: float = 0.02):
        self.rounds, self.noise = rounds, noise

    def fit(self, votes: np.ndarray, given: np.ndarray, counts: np.ndarray) -> LabelModel:
        m, n = votes.shape[1], counts.astype(float)
        v = votes.astype(float)
        self.prior, self.say = 0.1, np.ones(m)
        self.rates = np.vstack([np.full(m, 0.02), np.full(m, 0.5)])
        self.correlations = np.eye(m)
        for _ in range(self.rounds if len(v) else 0):
            p = self.posterior(v, given)
            for y, w in ((0, n * (1 - p)), (1, n * p)):
                self.rates[y] = (w @ v + 0.5) / (w.sum() + 1)
            self.prior = float(np.clip((n @ p + 1) / (n.sum() + 2), 1e-4, 0.9))
            left = v - self.rates[0] * (1 - p)[:, None] - self.rates[1] * p[:, None]
            cov = (left * n[:, None]).T @ left
            size = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            self.correlations = cov / np.outer(size, size)
            self.say = 1 / (1 + np.maximum(self.correlations - np.eye(m), 0).sum(axis=1))
        return self

    def posterior(self, votes: np.ndarray, given: np.ndarray | None = None) -> np.ndarray:
        no, yes = self.rates
        on, off = np.log(yes / no), np.log((1 - yes) / (1 - no))
        z = np.log(self.prior / (1 - self.prior)) + np.where(votes > 0, on, off) @ self.say
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        if given is not None:
            p = np.where(given < 0, p, np.where(given > 0, 1 - self.noise, self.noise))
        return p


class Logistic:
    """Logistic regression on soft labels over sparse rows (index, value), by full-batch gradient steps with momentum."""

    def __init__(self, width: int, penalty: float = 1e-3, steps: int = 400, rate: float = 1.0):
        self.weights, self.bias = np.zeros(width), 0.0
        self.penalty, self.steps, self.rate = penalty, steps, rate

    def fit(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, target: np.ndarray, balance: bool = True) -> Logistic:
        n = len(target)
        if not n:
            return self
        mass = np.ones(n)
        if balance:
            yes = max(target.sum(), 1e-9)
            mass = target * (n / 2 / yes) + (1 - target) * (n / 2 / max(n - yes, 1e-9))
            mass *= n / mass.sum()
        moved, shift = np.zeros_like(self.weights), 0.0
        for _ in range(self.steps):
            z = np.bincount(row, self.weights[col] * value, n) + self.bias
            error = mass * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
            slope = np.bincount(col, error[row] * value, len(self.weights)) / n + self.penalty * self.weights
            moved = 0.9 * moved - self.rate * slope
            shift = 0.9 * shift - self.rate * error.mean()
            self.weights, self.bias = self.weights + moved, self.bias + shift
        return self
