"""Token ids, bounded training samples and small networks shared by the classifiers."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import REMEMBERED

#: Runs of letters, digits and bytes above 127, and runs of other visible ASCII characters.
PARTS = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@\[-`{-~]+")


class Buckets(dict):
    """Bucket of a word by hash, one of ``size``."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBERED:
            self.clear()
        at = self[word] = xxhash.xxh3_64_intdigest(word) % self.size
        return at

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def labelled(labels: DataFrame, label: str, rows: int, learned) -> DataFrame:
    """(doc_id, label) of at most ``rows`` documents with each label value, spread by hash of the id.

    ``learned`` is a predicate on doc_id. Rows without an id or a label are left out; of rows
    that repeat an id the largest label counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & learned(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    some = [
        known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for value in (0, 1)
    ]
    return some[0].union(some[1])


def adam(params: list[np.ndarray], rate: float = 0.01):
    """A step function: gradients in, parameters changed in place."""
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    count = 0

    def step(grads: list[np.ndarray]) -> None:
        nonlocal count
        count += 1
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.99**count)) + 1e-8)

    return step


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def calibration(logits: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """(scale, shift) for logits of a balanced sample, where ``share`` of all documents have label 1.

    One over the scale is the temperature. Fitted by Newton steps on the cross entropy, weighted to the share.
    """
    if not len(labels) or labels.min() == labels.max():
        return 1.0, 0.0
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    x = np.stack([logits, np.ones_like(logits)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ w)
        grad = x.T @ (weight * (p - labels)) + 1e-2 * (w - [1.0, 0.0])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, np.abs(step).max())
    return float(max(w[0], 1e-3)), float(w[1])
