"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  Its features are shares of character classes, word
lengths and repetition, each of the line itself and of its two neighbours; the
chain carries runs of bad lines.  Only documents are labelled, so line labels
are found in rounds: lines of good documents are good, those of bad documents
start as bad and are then relabelled by the model's own decoding, keeping the
worst line bad.  A document's quality is the length-weighted mean of its lines'
forward-backward marginals, calibrated to a probability on the labelled sample.

Defined results: null and empty texts are one empty line.  Texts are scored
whole; line counts and lengths have no bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm import crf
from lexloom.llm.runtime import held_out, labelled_sample, lean, slices, text_or_empty
from lexloom.llm.textwords import _RINV, _R, _VALUE, _powers, mix

#: Labelled documents of each class that a model is fitted on, and the longest text among them.
FIT_PER_CLASS, FIT_CHARS = 400, 20_000
RELABEL_ROUNDS = 3
#: Scores from which a document counts as good.
GOOD_FROM = 0.3
#: Text whose lines are in memory at a time.
BATCH_BYTES = 1 << 20

_CLASS = np.zeros(256, np.uint8)  # 0: other symbols
for _c in range(256):
    _ch = chr(_c)
    _CLASS[_c] = (
        1 if 65 <= _c <= 90 else 2 if 97 <= _c <= 122 else 3 if 48 <= _c <= 57 else 4 if _ch in " \t\r" else 5 if _ch in ".,;:'\"-?()" else 6 if _c >= 128 else 7 if _c == 10 else 0
    )
_pows = [_powers(_R, 1 << 16), _powers(_RINV, 1 << 16)]


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line, lines of each text, length of every line in bytes)."""
    raw = "\n".join(texts).encode("utf-8", "surrogatepass")
    lines = np.array([t.count("\n") + 1 for t in texts])
    b = np.frombuffer(raw, np.uint8)
    kind = _CLASS[b]
    cuts = np.flatnonzero(kind == 7)
    start = np.concatenate([[0], cuts + 1]).astype(np.int64)
    end = np.concatenate([cuts, [len(b)]]).astype(np.int64)
    size = (end - start).astype(np.float64)

    def counted(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(b) + 1, np.int32)
        np.cumsum(flags, out=sums[1:])
        return (sums[end] - sums[start]).astype(np.float64)

    upper, lower, digit, mark, other, high = (counted(kind == k) for k in (1, 2, 3, 5, 0, 6))
    same = np.zeros(len(b), bool)
    if len(b) > 1:
        same[1:] = (b[1:] == b[:-1]) & (kind[1:] != 4)
    doubled = counted(same)
    # words: runs of anything but white space
    gap = np.concatenate([[True], (kind == 4) | (kind == 7), [True]])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    first, last = edges[::2], edges[1::2]
    pows = _pows if len(b) < len(_pows[0]) else [_powers(_R, len(b) + 1), _powers(_RINV, len(b) + 1)]
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_VALUE[b] * pows[0][: len(b)], out=sums[1:])
    word = mix((sums[last] - sums[first]) * pows[1][first])
    of = np.searchsorted(start, first, "right") - 1
    n = len(start)
    words = np.bincount(of, minlength=n).astype(np.float64)
    again = np.zeros(len(word), bool)
    if len(word) > 1:
        again[1:] = (word[1:] == word[:-1]) & (of[1:] == of[:-1])
    repeated = np.bincount(of[again], minlength=n).astype(np.float64)
    distinct = np.bincount(of[np.unique(mix(word + of.astype(np.uint64) * np.uint64(_R)), return_index=True)[1]], minlength=n).astype(np.float64) if len(word) else np.zeros(n)
    single = np.bincount(of[(last - first) == 1], minlength=n).astype(np.float64) if len(word) else np.zeros(n)
    long_ = np.bincount(of[(last - first) > 24], minlength=n).astype(np.float64) if len(word) else np.zeros(n)
    chars, some = np.maximum(size, 1), np.maximum(words, 1)
    letters = np.maximum(upper + lower + high, 1)
    shares = np.stack([upper / letters, digit / chars, mark / chars, other / chars, high / chars, doubled / chars, repeated / some, 1 - distinct / some, single / some, long_ / some], 1)
    plain = np.stack([np.log1p(size) / 6, np.log1p(words) / 4, np.minimum(size / some, 20) / 10], 1)
    steps = np.concatenate([shares > t for t in (0.02, 0.1, 0.3, 0.6)], 1)
    own = np.concatenate([shares, plain, steps, (words == 0)[:, None], ((words > 0) & (words <= 3))[:, None]], 1).astype(np.float32)
    # neighbours within the same text
    text_of = np.repeat(np.arange(len(texts)), lines)
    before, after = np.zeros_like(shares, np.float32), np.zeros_like(shares, np.float32)
    if n > 1:
        joined = (text_of[1:] == text_of[:-1])[:, None]
        before[1:] = np.where(joined, shares[:-1], 0)
        after[:-1] = np.where(joined, shares[1:], 0)
    return np.concatenate([own, before, after, np.ones((n, 1), np.float32)], 1), lines, size


def logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression (the last column of ``x`` should be 1), by Newton steps."""
    w = np.zeros(x.shape[1])
    weights = weights / weights.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weights * (y - p)) - ridge * w
        h = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class QualityModel:
    """A fitted line model and the calibration of document means."""

    chain: crf.Crf
    scale: np.ndarray
    prior: float

    def _means(self, x: np.ndarray, lines: np.ndarray, size: np.ndarray) -> np.ndarray:
        good = crf.marginals(self.chain, x, lines)[:, 1]
        of = np.repeat(np.arange(len(lines)), lines)
        weight = size + 1
        return np.bincount(of, weight * good, len(lines)) / np.bincount(of, weight, len(lines))

    @staticmethod
    def _shape(mean: np.ndarray) -> np.ndarray:
        m = np.clip(mean, 1e-4, 1 - 1e-4)
        return np.stack([np.log(m / (1 - m)), mean, np.ones(len(mean))], 1)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability that each text is good."""
        if not texts:
            return np.zeros(0)
        x, lines, size = line_features(texts)
        return 1 / (1 + np.exp(-np.clip(self._shape(self._means(x, lines, size)) @ self.scale, -30, 30)))


def fit(rows: list[tuple[str, int]], share_good: float | None = None) -> QualityModel | None:
    """Fit on (text, label) rows; ``share_good`` is the share of good rows among all labelled ones.  None without both classes."""
    y = np.array([r[1] for r in rows])
    if len(rows) == 0 or len(set(y.tolist())) < 2:
        return None
    x, lines, size = line_features([r[0] for r in rows])
    of = np.repeat(np.arange(len(rows)), lines)
    label = y[of].copy()
    share = float(y.mean()) if share_good is None else min(max(share_good, 0.01), 0.99)
    weights = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    even = np.where(y == 1, 1 / max(1, (label == 1).sum()), 1 / max(1, (label == 0).sum())) * len(x) / 2
    chain = None
    for k in range(RELABEL_ROUNDS):
        chain = crf.train(x, label, lines, 2, rounds=30 if k else 80, weights=even if k == 0 else None, start=chain)
        p = crf.marginals(chain, x, lines)[:, 1]
        label = np.where(y[of] == 1, 1, (p > 0.5).astype(int))
        worst = np.full(len(rows), np.inf)
        np.minimum.at(worst, of, p)
        label[(y[of] == 0) & (p <= worst[of])] = 0
    model = QualityModel(chain, np.zeros(3), share)
    model.scale = logistic(model._shape(model._means(x, lines, size)), y.astype(float), weights)
    return model


def fit_from(docs: DataFrame, labels: DataFrame) -> QualityModel | None:
    """Fit on the bounded labelled sample of ``docs``."""
    rows = labelled_sample(docs, labels, "quality", FIT_PER_CLASS, FIT_CHARS)
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out("doc_id")).agg(F.avg("quality")).first()[0]
    return fit(rows, known)


def score(docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of each row; without a model every score is 1 (nothing is known to be bad)."""
    kind = docs.select(id_col).dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, BATCH_BYTES):
                texts = part.column(1).to_pylist()
                found = model.scores(texts) if model else np.ones(len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(lean(run), f"doc_id {kind}, score double")


def keep(docs: DataFrame, model: QualityModel | None, text_col: str = "text", least: float = GOOD_FROM) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``least`` or more; one pass, nothing is shuffled."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at, BATCH_BYTES):
                texts = [t or "" for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(model.scores(texts) >= least)) if model else part

    return docs.mapInArrow(lean(run), docs.schema)
