"""Linear-chain conditional random fields over dense features, in numpy.

Sequences are padded into batches, so each step along the chain is one array
operation over all of a batch's sequences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Crf:
    """Weights: ``emit`` (features by labels), ``move`` (label before by label after), ``start`` and ``end``."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @classmethod
    def zeros(cls, features: int, labels: int) -> Crf:
        return cls(np.zeros((features, labels)), np.zeros((labels, labels)), np.zeros(labels), np.zeros(labels))

    def arrays(self) -> list[np.ndarray]:
        return [self.emit, self.move, self.start, self.end]


def _pad(values: np.ndarray, lengths: np.ndarray, longest: int) -> np.ndarray:
    """Rows of consecutive sequences as (sequence, step, ...)."""
    out = np.zeros((len(lengths), longest, *values.shape[1:]), values.dtype)
    out[np.arange(longest) < lengths[:, None]] = values
    return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis=axis)) + m.squeeze(axis)


def _batches(lengths: np.ndarray, cells: int = 60_000) -> list[np.ndarray]:
    """Sequence numbers by length, in batches of bounded padded size; a longer sequence stands alone."""
    order = np.argsort(lengths, kind="stable")
    out, i = [], 0
    while i < len(order):
        j = i + 1
        while j < len(order) and (j - i + 1) * max(1, lengths[order[j]]) <= cells:
            j += 1
        out.append(order[i:j])
        i = j
    return out


def _forward_backward(model: Crf, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log partition, forward, backward) of padded emission scores; sequences have one step at least."""
    n, longest, labels = scores.shape
    fwd, bwd = np.zeros_like(scores), np.zeros_like(scores)
    fwd[:, 0] = model.start + scores[:, 0]
    for t in range(1, longest):
        fwd[:, t] = _lse(fwd[:, t - 1, :, None] + model.move, 1) + scores[:, t]
    rows = np.arange(n)
    z = _lse(fwd[rows, lengths - 1] + model.end, 1)
    bwd[rows, lengths - 1] = model.end
    for t in range(longest - 2, -1, -1):
        step = _lse(model.move + (scores[:, t + 1] + bwd[:, t + 1])[:, None, :], 2)
        inside = (t < lengths - 1)[:, None]
        bwd[:, t] = np.where(inside, step, bwd[:, t])
    return z, fwd, bwd


def marginals(model: Crf, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probability of each label at each step; ``x`` holds the sequences' rows one after another."""
    lengths = np.asarray(lengths)
    out = np.zeros((len(x), len(model.start)))
    emit = (x @ model.emit.astype(x.dtype)).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    for batch in _batches(lengths):
        batch = batch[lengths[batch] > 0]
        if not len(batch):
            continue
        size = lengths[batch]
        at = np.repeat(starts[batch], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        scores = _pad(emit[at], size, int(size.max()))
        z, fwd, bwd = _forward_backward(model, scores, size)
        out[at] = np.exp(fwd + bwd - z[:, None, None])[np.arange(scores.shape[1]) < size[:, None]]
    return out


def viterbi(model: Crf, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The most likely labels of rows of features; among equals the smaller label."""
    return decode(model, (x @ model.emit.astype(x.dtype)).astype(np.float64), lengths)


def decode(model: Crf, emit: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The most likely labels given the emission scores of every step; among equals the smaller label."""
    lengths = np.asarray(lengths)
    out = np.zeros(len(emit), np.int64)
    starts = np.cumsum(lengths) - lengths
    for batch in _batches(lengths):
        batch = batch[lengths[batch] > 0]
        if not len(batch):
            continue
        size = lengths[batch]
        at = np.repeat(starts[batch], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        scores = _pad(emit[at], size, int(size.max()))
        n, longest, labels = scores.shape
        best = model.start + scores[:, 0]
        back = np.zeros(scores.shape, np.int64)
        for t in range(1, longest):
            step = best[:, :, None] + model.move
            back[:, t] = step.argmax(1)
            new = step.max(1) + scores[:, t]
            best = np.where((t < size)[:, None], new, best)
        rows = np.arange(n)
        label = (best + model.end).argmax(1)
        path = np.zeros((n, longest), np.int64)
        for t in range(longest - 1, -1, -1):
            here = t < size
            path[:, t] = np.where(here, label, 0)
            if t:
                label = np.where(here, back[rows, t, label], label)
        out[at] = path[np.arange(longest) < size[:, None]]
    return out


def train(x: np.ndarray, y: np.ndarray, lengths: np.ndarray, labels: int, ridge: float = 1e-3, rounds: int = 150, rate: float = 0.1, weights: np.ndarray | None = None, start: Crf | None = None) -> Crf:
    """Fit by Adam on the mean log-likelihood per step less ``ridge`` times the squared weights; deterministic.

    ``weights`` weighs whole sequences.
    """
    lengths = np.asarray(lengths)
    weights = np.ones(len(lengths)) if weights is None else weights
    starts = np.cumsum(lengths) - lengths
    prepared = []
    for batch in _batches(lengths):
        batch = batch[lengths[batch] > 0]
        if not len(batch):
            continue
        size = lengths[batch]
        at = np.repeat(starts[batch], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        mask = np.arange(int(size.max())) < size[:, None]
        prepared.append((x[at], _pad(np.eye(labels)[y[at]], size, int(size.max())), size, mask, weights[batch], y[at]))
    steps = max(1.0, float((lengths * weights).sum()))
    model = start or Crf.zeros(x.shape[1], labels)
    first = [np.zeros_like(a) for a in model.arrays()]
    second = [np.zeros_like(a) for a in model.arrays()]
    for k in range(1, rounds + 1):
        grads = [np.zeros_like(a) for a in model.arrays()]
        for rows, gold, size, mask, w, _ in prepared:
            scores = _pad((rows @ model.emit.astype(rows.dtype)).astype(np.float64), size, mask.shape[1])
            z, fwd, bwd = _forward_backward(model, scores, size)
            p = np.exp(fwd + bwd - z[:, None, None]) * mask[:, :, None]
            wide = w[:, None, None]
            grads[0] += rows.T @ ((gold - p) * wide)[mask].astype(rows.dtype)
            n = np.arange(len(size))
            grads[2] += ((gold[:, 0] - p[:, 0]) * w[:, None]).sum(0)
            grads[3] += ((gold[n, size - 1] - p[n, size - 1]) * w[:, None]).sum(0)
            if mask.shape[1] > 1:
                both = (mask[:, 1:] * w[:, None])[:, :, None, None]
                pair = np.exp(fwd[:, :-1, :, None] + model.move + (scores[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None])
                seen = gold[:, :-1, :, None] * gold[:, 1:, None, :]
                grads[1] += ((seen - pair) * both).sum((0, 1))
        for a, g, m, v in zip(model.arrays(), grads, first, second):
            g = g / steps - 2 * ridge * a
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return model
