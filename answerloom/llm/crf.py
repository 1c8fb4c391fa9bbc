"""A linear-chain conditional random field with two labels, in numpy."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np


class Crf:
    """Weights of features by label and of neighbouring labels."""

    def __init__(self, weights: dict[str, tuple[float, float]], steps: list[list[float]]) -> None:
        self.weights = weights
        self.steps = steps

    def viterbi(self, sequence: Sequence[Sequence[str]]) -> list[int]:
        """The most likely labels."""
        if not sequence:
            return []
        (t00, t01), (t10, t11) = self.steps
        get, none = self.weights.get, (0.0, 0.0)
        back, a, b = [], 0.0, 0.0
        for i, names in enumerate(sequence):
            e0 = e1 = 0.0
            for name in names:
                w = get(name, none)
                e0 += w[0]
                e1 += w[1]
            if i == 0:
                a, b = e0, e1
                continue
            from0, from1 = (a + t00, b + t10), (a + t01, b + t11)
            back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
            a, b = max(from0) + e0, max(from1) + e1
        labels = [int(b > a)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def _log_sum(a: float, b: float) -> float:
    high = max(a, b)
    return high + math.log(math.exp(a - high) + math.exp(b - high))


def _marginals(emit: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each place and expected counts of label pairs."""
    n = len(emit)
    forward, backward = [tuple(emit[0])], [(0.0, 0.0)]
    for e in emit[1:]:
        a = forward[-1]
        forward.append(
            tuple(e[y] + _log_sum(a[0] + steps[0, y], a[1] + steps[1, y]) for y in (0, 1))
        )
    for e in emit[:0:-1]:
        b = backward[-1]
        backward.append(
            tuple(
                _log_sum(steps[y, 0] + e[0] + b[0], steps[y, 1] + e[1] + b[1]) for y in (0, 1)
            )
        )
    f, b = np.array(forward), np.array(backward[::-1])
    total = _log_sum(*forward[-1])
    pairs = np.zeros((2, 2))
    if n > 1:
        joint = f[:-1, :, None] + steps[None] + (emit[1:] + b[1:])[:, None, :] - total
        pairs = np.exp(joint).sum(axis=0)
    return np.exp(f + b - total), pairs


def train(
    sequences: Sequence[Sequence[Sequence[str]]],
    labels: Sequence[Sequence[int]],
    epochs: int = 12,
    rate: float = 0.3,
    decay: float = 1e-4,
) -> Crf:
    """Maximum likelihood by AdaGrad, one sequence at a time in the given order."""
    names: dict[str, int] = {}
    coded = []
    for sequence, own in zip(sequences, labels, strict=True):
        if sequence:
            ids = [[names.setdefault(f, len(names)) for f in x] for x in sequence]
            flat = np.array([i for x in ids for i in x])
            starts = np.cumsum([0] + [len(x) for x in ids[:-1]])
            place = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
            coded.append((flat, starts, place, np.array(own)))
    w, steps = np.zeros((len(names), 2)), np.zeros((2, 2))
    seen, seen_steps = np.full_like(w, 1e-6), np.full_like(steps, 1e-6)
    for _ in range(epochs):
        for flat, starts, place, own in coded:
            emit = np.add.reduceat(w[flat], starts, axis=0)
            p, pairs = _marginals(emit, steps)
            error = -p
            error[np.arange(len(own)), own] += 1.0
            gradient = np.zeros_like(w)
            np.add.at(gradient, flat, error[place])
            gradient -= decay * w
            seen += gradient**2
            w += rate * gradient / np.sqrt(seen)
            found = np.zeros((2, 2))
            np.add.at(found, (own[:-1], own[1:]), 1.0)
            gradient = found - pairs - decay * steps
            seen_steps += gradient**2
            steps += rate * gradient / np.sqrt(seen_steps)
    return Crf({f: (float(w[i, 0]), float(w[i, 1])) for f, i in names.items()}, steps.tolist())
