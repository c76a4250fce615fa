"""Toxicity by compression distance.

There are two zstandard dictionaries, one of ordinary and one of toxic text.  A text is
cut into overlapping windows of a few words, each window is compressed with either, and
the difference of the two lengths says how much better toxic text explains it.  The
largest differences of a text and the shares of its windows that shrink by some bytes
are calibrated to a probability on the labelled sample.

Only documents are labelled, and most words of a toxic document are ordinary.  The
toxic dictionary therefore consists of the passages of toxic documents that hold byte
sequences frequent there and rare elsewhere, counted by distinct contexts so that copies
of one document count once.  The ordinary dictionary is trained by zstandard; the toxic
one is given to it as content, since the trainer drops most of so few short passages
(README).  It is preceded by the ordinary dictionary, so that ordinary windows compress
nearly alike under both.

Defined results: null and empty texts have no windows; their differences are 0.
Texts are scored whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.quality import logistic
from lexloom.llm.runtime import held_out, labelled_sample, slices, text_or_empty
from lexloom.llm.textwords import mix

#: Labelled documents of each class that a model is fitted on, and the longest text among them.
FIT_PER_CLASS, FIT_CHARS = 1200, 20_000
#: Text scored at a time.
BATCH_BYTES = 4 << 20
#: Words of a window, and from one window to the next.
WINDOW, STRIDE = 6, 4
ORDINARY_BYTES, TOXIC_BYTES = 16 << 10, 8 << 10
#: Bytes of the ordinary dictionary that each window is preceded by, and what follows it: zstandard seeks no matches in the last bytes.
KNOWN, TAIL = 48, bytes(range(1, 13))
#: Bytes of sequences, how surprising (in nats) their contexts in toxic text must be if both texts were alike, and how much more frequent they must be there.
GRAMS, LEAST_SURPRISE, LEAST_RATIO = (5, 6, 7, 8), 21.0, 6.0
LARGEST = 3
#: Differences whose share of the windows is a feature, and what the shares are multiplied by (up to 1).
STEPS = ((2, 3), (3, 5), (5, 10))


def _spaced(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").split()) + b" "


def windows(text: str, size: int = WINDOW, stride: int = STRIDE) -> list[bytes]:
    """Overlapping runs of words, between spaces; none for a text without words."""
    w = text.lower().encode("utf-8", "surrogatepass").split()
    if not w:
        return []
    return [b" " + b" ".join(w[i : i + size]) + b" " for i in range(0, max(1, len(w) - (size - stride)), stride)]


def _grams(b: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(code of each run of ``size`` bytes, whether it stays within a word and the space before it)."""
    a = np.frombuffer(b, np.uint8)
    n = max(0, len(a) - size + 1)
    code, inside = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(size):
        code = (code << np.uint64(8)) | a[i : n + i]
        if i:
            inside &= a[i : n + i] != 32
    return code, inside


def _contexts(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte sequences and the number of distinct contexts each stands in."""
    codes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for t in texts:
        code, inside = _grams(t, size)
        a, n = np.frombuffer(t, np.uint8), len(code)
        before = np.zeros(n, np.uint64)
        for k in range(1, 7):
            before[k:] = before[k:] * np.uint64(257) + a[: max(0, n - k)]
        place, at = np.unique(mix(code[inside] * np.uint64(31) + mix(before[inside])), return_index=True)
        codes.append(code[inside][at])
        places.append(place)
    _, at = np.unique(np.concatenate(places), return_index=True)
    return np.unique(np.concatenate(codes)[at], return_counts=True)


def toxic_passages(toxic: list[bytes], ordinary: list[bytes]) -> Counter:
    """Passages of toxic texts that are covered by tell-tale byte sequences, and how often each occurs."""
    here, there = max(1, sum(map(len, toxic))), max(1, sum(map(len, ordinary)))
    share = here / (here + there)
    telling = {}
    for size in GRAMS:
        seen, count = _contexts(toxic, size)
        other, other_count = _contexts(ordinary, size)
        at = np.searchsorted(other, seen)
        at[at == len(other)] = 0
        elsewhere = np.where(other[at] == seen, other_count[at], 0) if len(other) else np.zeros(len(seen))
        q = count / (count + elsewhere)
        surprise = count * np.log(q / share) + elsewhere * np.log(np.maximum(1 - q, 1e-300) / (1 - share))
        telling[size] = seen[(q > share) & (surprise >= LEAST_SURPRISE) & (count / here >= LEAST_RATIO * (elsewhere + 0.5) / there)]
    found: Counter = Counter()
    for t in toxic:
        covered = np.zeros(len(t) + 1, np.int8)
        for size in GRAMS:
            hit = np.isin(_grams(t, size)[0], telling[size])
            for k in range(size):
                covered[k : k + len(hit)] |= hit
        edges = np.flatnonzero(np.diff(np.concatenate([[0], covered])))
        found.update(t[a : b + (t[b : b + 1] == b" ")] for a, b in zip(edges[::2], edges[1::2]))
    return found


def _ordinary_dictionary(texts: list[str]) -> bytes:
    samples = [w for t in texts for w in windows(t)]
    try:
        trained = zstandard.train_dictionary(2 * ORDINARY_BYTES, samples[:: max(1, len(samples) // 100_000)]).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        trained = b"".join(samples)
    return trained[-ORDINARY_BYTES:]


@dataclass
class ToxicityModel:
    """Dictionaries and calibration weights."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray

    def __getstate__(self) -> dict:
        return {"ordinary": self.ordinary, "toxic": self.toxic, "weights": self.weights}

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        parameters = zstandard.ZstdCompressionParameters(
            window_log=17, chain_log=16, hash_log=17, search_log=8, min_match=6, target_length=64, strategy=zstandard.STRATEGY_LAZY2, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        held = zstandard.ZstdCompressionDict(content or b" " * 16, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=parameters)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=parameters)

    @cached_property
    def _both(self) -> tuple:
        return self._compressor(self.ordinary).compress, self._compressor(self.ordinary + self.toxic).compress

    def differences(self, text: str) -> list[int]:
        """How many bytes shorter each window is with the toxic dictionary, in order."""
        one, two = self._both
        known = self.ordinary[-KNOWN:]  # else a window that hardly shrinks is stored as it is, and its length says nothing
        return [len(one(w)) - len(two(w)) for w in (known + w + TAIL for w in windows(text))]

    def features(self, text: str) -> list[float]:
        """The largest differences, the number of windows, and how many of them shrink by how much."""
        found = np.array(self.differences(text), np.float64)
        n = len(found)
        largest = [*np.sort(found)[::-1][:LARGEST], *[0.0] * LARGEST][:LARGEST]
        size = float(np.log1p(n))
        shares = [min(1.0, (found >= least).sum() / max(1, n) * times) for least, times in STEPS]
        return [*largest, size, largest[0] * size / 10, *shares, float(np.log1p((found >= 3).sum())), float(found.clip(0).sum() / max(1, n)), 1.0]

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability that each text is toxic."""
        if not texts:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(np.array([self.features(t) for t in texts]) @ self.weights, -30, 30)))


def fit(rows: list[tuple[str, int]], share_toxic: float | None = None) -> ToxicityModel | None:
    """Fit on (text, label) rows; ``share_toxic`` is the share of toxic rows among all labelled ones.  None without both classes."""
    toxic, ordinary = [t for t, y in rows if y == 1], [t for t, y in rows if y == 0]
    if not toxic or not ordinary:
        return None
    passages = toxic_passages([_spaced(t) for t in toxic], [_spaced(t) for t in ordinary])
    content = b"".join(p for p, n in sorted(passages.items(), key=lambda x: (x[1], x[0])) if n >= min(3, max(passages.values())))
    model = ToxicityModel(_ordinary_dictionary(ordinary), content[-TOXIC_BYTES:], np.zeros(LARGEST + len(STEPS) + 5))
    y = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    share = y.mean() if share_toxic is None else min(max(share_toxic, 0.01), 0.99)
    x = np.array([model.features(t) for t in toxic + ordinary])
    model.weights = logistic(x, y, np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())), 1e-4)
    return model


def fit_from(docs: DataFrame, labels: DataFrame) -> ToxicityModel | None:
    """Fit on the bounded labelled sample of ``docs``."""
    rows = labelled_sample(docs, labels, "toxic", FIT_PER_CLASS, FIT_CHARS)
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out("doc_id")).agg(F.avg("toxic")).first()[0]
    return fit(rows, known)


def score(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of each row; without a model every score is 0 (nothing is known to be toxic)."""
    kind = docs.select(id_col).dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, BATCH_BYTES):
                texts = part.column(1).to_pylist()
                found = model.scores(texts) if model else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
