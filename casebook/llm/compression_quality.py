"""Quality by compression: how much better a text packs with a dictionary of good text than with one of bad text.

Two zstandard dictionaries are built, from good and from bad labelled documents. A text is cut into pieces of `piece`
bytes (all of it), each piece is packed with either dictionary, and the packed sizes are summed. The score comes from the
difference of both sums over their total, with both packed sizes a byte beside it, through a logistic calibration fitted
on labelled documents that no dictionary has seen.

The model is fitted on at most `sample` labelled documents (those with the smallest hash of their id, so the same ones in
every run); scoring is a single pass without a shuffle. Null and empty texts get the score of a text of no bytes.
Without documents of both labels every score is the share of good labels (0.5 without any). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed_sizes(blob: bytes, packers: list[zstandard.ZstdCompressor], piece: int) -> list[int]:
    """Packed size of all pieces of a text with each packer."""
    return [sum(len(p.compress(blob[at : at + piece])) for at in range(0, len(blob), piece)) for p in packers]


def traits(n: int, good: int, bad: int) -> list[float]:
    """What the calibration sees of a text of n bytes: the normalised difference and both sizes a byte."""
    if not n:
        return [0.0] * 6
    gap, g, b = (bad - good) / (good + bad), good / n, bad / n
    return [gap, g, b, g * g, gap * gap, 1 / (1 + n / 100)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 40) -> np.ndarray:
    """Weights of a logistic regression with intercept (Newton steps on standardised columns, folded back)."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (y - p) - ridge * len(x) * np.r_[0, w[1:]]
        bend = (z * (p * (1 - p))[:, None]).T @ z + ridge * len(x) * np.diag(np.r_[0, np.ones(len(w) - 1)]) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.r_[w[0] - (w[1:] * mean / scale).sum(), w[1:] / scale]


class CompressionModel:
    """Both dictionaries and the calibration; packers are made where they are used."""

    def __init__(self, good: bytes, bad: bytes, weights: np.ndarray, piece: int, level: int):
        self.good, self.bad, self.weights, self.piece, self.level = good, bad, weights, piece, level

    def packers(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for content in (self.good, self.bad):
            words = zstandard.ZstdCompressionDict(content)
            words.precompute_compress(self.level)
            settings = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
            out.append(zstandard.ZstdCompressor(dict_data=words, level=self.level, **settings) if content else zstandard.ZstdCompressor(level=self.level, **settings))
        return out

    def score(self, text: str | None, packers: list[zstandard.ZstdCompressor]) -> float:
        blob = (text or "").encode("utf-8", "surrogatepass")
        return self.of_traits(traits(len(blob), *packed_sizes(blob, packers, self.piece)))

    def of_traits(self, row: list[float]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[0] + np.dot(self.weights[1:], row), -30, 30))))


def build_dictionary(texts: list[bytes], size: int, piece: int) -> bytes:
    """A zstandard dictionary of pieces of the texts; the pieces themselves where they are too few to train on."""
    samples = [t[at : at + piece] for t in texts for at in range(0, len(t), piece)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def learn_compression(
    documents: DataFrame, labels: DataFrame, train: Column, sample: int = 6000, size: int = 1 << 16, piece: int = 1024, level: int = 3
) -> CompressionModel:
    """A model of `labels.quality` from labelled rows where `train` (on doc_id) holds; at most `sample` of either label."""
    known = labels.where(train & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    share = known.agg(F.avg("quality"), F.count("*")).first()
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(sample) for q in (0, 1)]
    picked = F.broadcast(chosen[0].union(chosen[1]))  # at most 2 * sample ids
    rows = documents.select("doc_id", "text").where("text is not null").join(picked, "doc_id").orderBy(order, "doc_id").collect()
    texts = {q: [r.text.encode("utf-8", "surrogatepass") for r in rows if r.quality == q] for q in (0, 1)}
    prior = float(share[0]) if share[1] else 0.5
    if not texts[0] or not texts[1]:
        odds = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
        return CompressionModel(b"", b"", np.r_[odds, np.zeros(6)], piece, level)
    half = {q: len(t) // 2 for q, t in texts.items()}
    words = {q: build_dictionary(t[: max(1, half[q])], size, piece) for q, t in texts.items()}
    model = CompressionModel(words[1], words[0], np.zeros(7), piece, level)
    packers = model.packers()
    rest = [(t, q) for q in (0, 1) for t in (texts[q][half[q] :] or texts[q])]
    x = np.array([traits(len(t), *packed_sizes(t, packers, piece)) for t, _ in rest])
    y = np.array([q for _, q in rest], dtype=float)
    model.weights = fit_logistic(x, y)
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    model.weights[0] += np.log(prior / (1 - prior)) - np.log(y.mean() / (1 - y.mean()))  # back to the share of all labels
    return model


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        packers = model.packers()
        for batch in batches:
            scores = [model.score(text.as_py(), packers) for text in batch.column(batch.num_columns - 1)]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], names=batch.schema.names[:-1] + ["score"])

    return run


def score_quality(rows: DataFrame, model: CompressionModel) -> DataFrame:
    """`rows`, whose last column is the text, with the score in its place."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_score(shared), rows.schema[:-1].add("score", "double"))
