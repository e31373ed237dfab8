"""Follow-the-regularised-leader (proximal) for logistic and multinomial models."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """Per-coordinate FTRL with elastic-net penalties over hashed sparse features.

    ``classes`` = 1 is a logistic model, more is multinomial. Weights are lazily derived
    from the accumulated gradients, so coordinates that never pass ``l1`` stay zero.
    """

    def __init__(self, dim: int, classes: int = 1, alpha: float = 0.3, beta: float = 1.0,
                 l1: float = 0.02, l2: float = 0.001):
        self.z = np.zeros((dim + 1, classes))
        self.n = np.zeros((dim + 1, classes))
        self.bias = dim  # the last coordinate; without penalty on its size
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def step(self, at: np.ndarray, x: np.ndarray, target) -> None:
        """One example: feature indices (distinct), their values, the class (or 0/1)."""
        at = np.append(at, self.bias)
        x = np.append(x, 1.0)
        w = self.weights(at)
        score = x @ w
        if w.shape[1] == 1:
            err = 1.0 / (1.0 + np.exp(-np.clip(score, -40, 40))) - target
        else:
            p = np.exp(score - score.max())
            err = p / p.sum()
            err[target] -= 1.0
        g = x[:, None] * err[None, :]
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g

    def fit(self, rows: list, epochs: int, seed: int = 5) -> "Ftrl":
        """``rows`` of (indices, values, target), in a shuffled order each epoch."""
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for k in rng.permutation(len(rows)):
                self.step(*rows[k])
        return self
