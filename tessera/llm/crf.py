"""A linear-chain conditional random field over sparse binary features.

Sequences are trained in equally long padded batches, so the forward and
backward recursions run over positions, and over all sequences at once.
"""

from __future__ import annotations

import numpy as np


def lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class LinearChain:
    """Feature 0 is padding and weighs nothing."""

    def __init__(self, features: int, labels: int):
        self.weights = np.zeros((features, labels))
        self.steps = np.zeros((labels, labels))
        self.start = np.zeros(labels)

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return self.weights[features].sum(-2)

    def forward_backward(self, emit: np.ndarray, mask: np.ndarray):
        """Log-potentials (n, length, labels) to log-likelihood normalisers, node
        marginals and expected step counts."""
        n, length, labels = emit.shape
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[:, 0] = self.start + emit[:, 0]
        for t in range(1, length):
            new = lse(forward[:, t - 1, :, None] + self.steps, 1) + emit[:, t]
            forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
        for t in range(length - 2, -1, -1):
            new = lse(self.steps + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], new, 0)
        total = lse(forward[:, -1], 1)
        nodes = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
        steps = np.zeros((labels, labels))
        for t in range(1, length):
            pair = np.exp(forward[:, t - 1, :, None] + self.steps + (emit[:, t] + backward[:, t])[:, None, :] - total[:, None, None])
            steps += (pair * mask[:, t, None, None]).sum(0)
        return total, nodes, steps

    def fit(self, features: np.ndarray, labels: np.ndarray, mask: np.ndarray, epochs: int, batch: int = 256, rate: float = 0.3, decay: float = 1e-3, seed: int = 7) -> LinearChain:
        """Adagrad on the regularised log-likelihood, from the present weights.
        features: (n, length, slots); labels: (n, length), or (n, length, labels) of
        probabilities, which count as independent of each other."""
        n, kinds = len(features), len(self.start)
        rng = np.random.default_rng(seed)
        seen = [np.full_like(x, 1e-6) for x in (self.weights, self.steps, self.start)]
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(n), max(1, n // batch)):
                f, y, m = features[rows], labels[rows], mask[rows]
                _, nodes, steps = self.forward_backward(self.emissions(f), m)
                true = (y if y.ndim == 3 else np.eye(kinds)[y]) * m[..., None]
                error = (nodes - true) / len(rows)
                slope = np.zeros_like(self.weights)
                np.add.at(slope, f.reshape(-1), np.repeat(error.reshape(-1, kinds), f.shape[-1], 0))
                slope[0] = 0
                observed = np.einsum("nta,ntb->ab", true[:, :-1], true[:, 1:])
                slopes = slope + decay * self.weights * (slope != 0), (steps - observed) / len(rows) + decay * self.steps, error[:, 0].sum(0) + decay * self.start
                for x, g, s in zip((self.weights, self.steps, self.start), slopes, seen, strict=True):
                    s += g * g
                    x -= rate * g / np.sqrt(s)
        return self

    def viterbi(self, emit: np.ndarray) -> list[int]:
        """The best labels of one sequence of log-potentials (length, labels)."""
        best, back = (self.start + emit[0]).tolist(), []
        steps, kinds = self.steps.tolist(), range(len(self.start))
        for row in emit[1:].tolist():
            here = [max(kinds, key=lambda a, b=b: best[a] + steps[a][b]) for b in kinds]
            best = [best[here[b]] + steps[here[b]][b] + row[b] for b in kinds]
            back.append(here)
        label = max(kinds, key=best.__getitem__)
        out = [label]
        for here in reversed(back):
            label = here[label]
            out.append(label)
        return out[::-1]
