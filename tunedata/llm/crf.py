"""Linear-chain conditional random field in numpy batches.

A position has a fixed number of feature ids, one from each of its columns;
its label scores are the sum of their weights. Sequences are run side by side,
in blocks of similar length, so that a step of the chain is one operation on
all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class Chain:
    """Weights of a chain with ``labels`` labels over ``features`` feature ids."""

    def __init__(self, features: int, labels: int):
        self.weights = np.zeros((features, labels))
        self.transitions = np.zeros((labels, labels))

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Label scores of each position, from its feature ids (positions x columns)."""
        out = np.zeros((len(ids), self.weights.shape[1]))
        for column in ids.T:
            out += self.weights[column]
        return out

    def marginals(self, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of each position, and expected transition counts."""
        out, pairs = np.zeros_like(scores), np.zeros_like(self.transitions)
        steps = np.exp(self.transitions - self.transitions.max())
        for at, real in blocks(lengths):
            local = np.exp(scores[at] - scores[at].max(2, keepdims=True))  # time x sequences x labels
            forward, backward = np.empty_like(local), np.ones_like(local)
            a = forward[0] = local[0] / local[0].sum(1, keepdims=True)
            for t in range(1, len(at)):
                b = (a @ steps) * local[t]
                a = np.where(real[t][:, None], b / b.sum(1, keepdims=True), a)
                forward[t] = a
            for t in range(len(at) - 2, -1, -1):
                b = (local[t + 1] * backward[t + 1]) @ steps.T
                backward[t] = np.where(real[t + 1][:, None], b / b.sum(1, keepdims=True), 1.0)
            both = forward * backward
            both /= both.sum(2, keepdims=True)
            out[at[real]] = both[real]
            right = (local * backward)[1:][real[1:]]
            joint = forward[:-1][real[1:]][:, :, None] * steps * right[:, None, :]
            pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        return out, pairs

    def best(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Viterbi: the likeliest label of each position along its sequence."""
        out = np.zeros(len(scores), np.int64)
        for at, real in blocks(lengths):
            local = scores[at]
            best, back = local[0], np.zeros(local.shape, np.int8)
            for t in range(1, len(at)):
                through = best[:, :, None] + self.transitions
                back[t] = through.argmax(1)
                best = np.where(real[t][:, None], through.max(1) + local[t], best)
            label = best.argmax(1)
            rows = np.arange(len(label))
            for t in range(len(at) - 1, -1, -1):
                out[at[t][real[t]]] = label[real[t]]
                label = np.where(real[t], back[t][rows, label], label)
        return out

    def fit(self, ids: np.ndarray, lengths: np.ndarray, labels: np.ndarray, rounds: int = 60,
            rate: float = 0.2, decay: float = 1e-3) -> Chain:
        """Maximise the penalised likelihood of the labelled sequences (Adam, whole batches)."""
        k, n = self.weights.shape[1], max(1, len(lengths))
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        inner = np.ones(len(labels), bool)
        inner[starts[lengths > 0]] = False
        seen = np.zeros((k, k))
        np.add.at(seen, (labels[:-1][inner[1:]], labels[1:][inner[1:]]), 1)
        truth = np.eye(k)[labels]
        params = [self.weights, self.transitions]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, rounds + 1):
            probable, pairs = self.marginals(self.scores(ids), lengths)
            wrong = truth - probable
            grad = np.zeros_like(self.weights)
            for column in ids.T:
                for y in range(k):
                    grad[:, y] += np.bincount(column, wrong[:, y], len(grad))
            for p, g, a, b in zip(params, [grad, seen - pairs], m, v, strict=True):
                g = g / n - decay * p
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p += rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-6)
        return self


# Positions that a block may hold, unless a single sequence is longer.
BLOCK = 1 << 17


def blocks(lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sequences of similar length, as positions (time x sequences) with a mask of the real
    ones; lengths in a block differ by a factor of two at most."""
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        shortest = lengths[order[at]]
        sizes = lengths[order[at:]]
        n = max(1, int(np.searchsorted(sizes, 2 * shortest, "right")))
        n = max(1, min(n, int(BLOCK // (2 * shortest)) or 1))
        pick = order[at:at + n]
        longest = lengths[pick[-1]]
        time = np.arange(longest)[:, None]
        real = time < lengths[pick]
        yield np.where(real, starts[pick] + time, starts[pick]), real
        at += n
