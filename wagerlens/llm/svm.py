"""Linear support vector machines on a bounded number of dense rows, by dual coordinate descent."""

from __future__ import annotations

import numpy as np


def train(
    x: np.ndarray, y: np.ndarray, cost: float = 1.0, epochs: int = 30, seed: int = 7
) -> np.ndarray:
    """Weights of the L2-regularised hinge-loss classifier of y (+1 or -1); rows of equal y weigh
    the same in sum. The last feature should be constant if a bias is wanted."""
    x = np.ascontiguousarray(x, dtype=np.float32)
    share = {s: len(y) / (2 * max(1, int((y == s).sum()))) for s in (-1, 1)}
    bound = cost * np.where(y > 0, share[1], share[-1])
    square = np.einsum("ij,ij->i", x, x) + 1e-9
    alpha = np.zeros(len(y))
    w = np.zeros(x.shape[1], dtype=np.float32)
    rng = np.random.RandomState(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            slope = y[i] * float(x[i] @ w) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), bound[i])
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                moved += abs(new - alpha[i])
                alpha[i] = new
        if moved < 1e-3:
            break
    return w
