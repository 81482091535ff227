"""Binary linear support vector machines on sparse rows, trained with numpy."""

from __future__ import annotations

import numpy as np

STEPS = 80
PENALTY = 2e-5


class SparseRows:
    """Rows as (feature, value) pairs laid end to end."""

    def __init__(self, features: list[np.ndarray], values: list[np.ndarray], width: int):
        lengths = np.array([len(f) for f in features], dtype=np.int64)
        self.width = width
        self.features = np.concatenate([np.empty(0, np.int64), *features]).astype(np.int64)
        self.values = np.concatenate([np.empty(0), *values])
        self.row = np.repeat(np.arange(len(lengths)), lengths)
        self.n = len(lengths)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * weights[self.features], minlength=self.n)

    def transposed_times(self, sides: np.ndarray) -> np.ndarray:
        return np.bincount(self.features, self.values * sides[self.row], minlength=self.width)


def train(rows: SparseRows, positive: np.ndarray, penalty: float = PENALTY, steps: int = STEPS):
    """Weights and intercept that minimise squared hinge loss, both classes weighing alike."""
    sign = np.where(positive, 1.0, -1.0)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum()))
    norms = np.bincount(rows.row, rows.values**2, minlength=rows.n)
    rate = 1.0 / (penalty + 2.0 * float((share * (norms + 1.0)).sum()))
    weights, bias = np.zeros(rows.width), 0.0
    ahead, ahead_bias, momentum = weights, bias, 1.0
    for _ in range(steps):
        slack = np.maximum(0.0, 1.0 - sign * (rows.times(ahead) + ahead_bias))
        pull = -2.0 * share * sign * slack
        new = ahead - rate * (rows.transposed_times(pull) + penalty * ahead)
        new_bias = ahead_bias - rate * float(pull.sum())
        grown = (1.0 + np.sqrt(1.0 + 4.0 * momentum**2)) / 2.0
        ahead = new + (momentum - 1.0) / grown * (new - weights)
        ahead_bias = new_bias + (momentum - 1.0) / grown * (new_bias - bias)
        weights, bias, momentum = new, new_bias, grown
    return weights, bias
