"""Quality classifier: random-indexing word vectors, pooled per document, into a two-layer network.

Every hashed word has a fixed sparse ternary index vector. Its word vector is the sum of the index
vectors of its neighbours over all documents (two to each side), so words that keep the same company have
like vectors. A document is the mean of its words' unit vectors and the mean absolute difference of
adjacent ones. A network of two layers, trained in numpy on a bounded sample of labelled rows, gives a
logit; a temperature and a shift fitted on rows that it has not seen turn it into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, remainder
from .features import PARTS, Buckets, adam, calibration, labelled, sigmoid


@dataclass(frozen=True)
class Quality:
    """buckets, width: of the word vectors. rows: labelled documents of each label that are learned from.

    fold, held: documents whose crc32 of the id leaves ``held`` modulo ``fold`` lend no label.
    """

    buckets: int = 16_384
    width: int = 32
    hidden: int = 24
    rows: int = 4_000
    epochs: int = 60
    fold: int = 5
    held: int = 0
    threshold: float = 0.3
    seed: int = 7


def index_vectors(buckets: int, width: int, seed: int) -> np.ndarray:
    """Four entries of +1 or -1 per row."""
    rng = np.random.default_rng(seed)
    out = np.zeros((buckets, width), np.float32)
    for _ in range(4):
        out[np.arange(buckets), rng.integers(0, width, buckets)] += rng.choice([-1, 1], buckets)
    return out


def contexts(ids: np.ndarray, doc: np.ndarray, index: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total`` the index vectors of up to two neighbours on each side, within a document."""
    step = 200_000
    for at in range(0, len(ids), step):
        low, high = max(0, at - 2), min(len(ids), at + step + 2)
        here, where = ids[low:high], doc[low:high]
        vectors = index[here]
        near = np.zeros_like(vectors)
        for gap in (1, 2):
            same = (where[gap:] == where[:-gap])[:, None]
            near[gap:] += vectors[:-gap] * same
            near[:-gap] += vectors[gap:] * same
        inner = slice(at - low, at - low + min(step, len(ids) - at))
        here, near = here[inner], near[inner]
        order = np.argsort(here, kind="stable")
        starts = np.flatnonzero(np.diff(here[order], prepend=-1))
        total[here[order][starts]] += np.add.reduceat(near[order], starts)


def texts_of(column, buckets: Buckets) -> Iterator[np.ndarray]:
    for data in column:
        yield buckets.of(PARTS.findall(data.as_py()))


def _contexts(q: Quality):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, index = Buckets(q.buckets), index_vectors(q.buckets, q.width, q.seed)
        total = np.zeros((q.buckets, q.width))
        for batch in batches:
            ids = list(texts_of(batch.column(0), buckets))
            if ids:
                doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
                contexts(np.concatenate(ids), doc, index, total)
        used = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used // 256, pa.int64()), pa.array(used, pa.int64()),
             pa.array([x.tobytes() for x in total[used]], pa.binary())],
            names=["block", "bucket", "vector"],
        )

    return run


def _sum(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    ids, at = np.unique(rows["bucket"], return_inverse=True)
    # Whole numbers: their sums don't depend on the order.
    vectors = np.stack([np.frombuffer(x, np.float64) for x in rows["vector"]])
    total = np.zeros((len(ids), vectors.shape[1]))
    np.add.at(total, at, vectors)
    return pd.DataFrame({"block": key[0], "bucket": ids, "vector": [x.tobytes() for x in total]})


def word_vectors(texts: DataFrame, q: Quality) -> np.ndarray:
    """Unit vectors by bucket; ``buckets`` x ``width`` floats, whatever the input."""
    schema = "block long, bucket long, vector binary"
    parts = texts.mapInArrow(_contexts(q), schema)
    out = np.zeros((q.buckets, q.width), np.float32)
    for row in parts.groupBy("block").applyInPandas(_sum, schema).collect():  # one row per bucket
        out[row["bucket"]] = np.frombuffer(row["vector"], np.float64)
    out -= out.sum(axis=0) / max(1, np.count_nonzero(out.any(axis=1))) * out.any(axis=1)[:, None]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    width = vectors.shape[1]
    out = np.zeros(2 * width + 1)
    if len(ids):
        some = vectors[ids]
        out[:width] = some.mean(axis=0)
        out[-1] = 1 / len(ids)
    if len(ids) > 1:
        out[width:-1] = np.abs(some[1:] - some[:-1]).mean(axis=0)
    return out


def _features(q: Quality, vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(q.buckets)
        for batch in batches:
            out = [pooled(x, vectors.value).tobytes() for x in texts_of(batch.column("text"), buckets)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(out, pa.binary())], names=["doc_id", "label", "x"]
            )

    return run


@dataclass(frozen=True)
class Network:
    mean: np.ndarray
    spread: np.ndarray
    layers: tuple[np.ndarray, ...]
    scale: float
    shift: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh((x - self.mean) / self.spread @ a + b) @ c + d

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * self.logits(x) + self.shift)


def fit(x: np.ndarray, y: np.ndarray, share: float, q: Quality) -> Network:
    """Four fifths train the layers, the rest the temperature. Without both labels every score is ``share``."""
    rng = np.random.default_rng(q.seed)
    order = rng.permutation(len(y))
    x, y = x[order], y[order]
    cut = len(y) * 4 // 5
    width = x.shape[1]
    mean, spread = (x[:cut].mean(axis=0), x[:cut].std(axis=0) + 1e-3) if cut else (np.zeros(width), np.ones(width))
    layers = [
        rng.normal(0, width**-0.5, (width, q.hidden)), np.zeros(q.hidden), rng.normal(0, q.hidden**-0.5, q.hidden),
        np.zeros(1),
    ]
    if not cut or y.min() == y.max():
        layers[2][:] = 0
        odds = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
        return Network(mean, spread, tuple(layers), 1.0, odds)
    step, z = adam(layers), (x - mean) / spread
    for _ in range(q.epochs):
        for part in np.array_split(rng.permutation(cut), max(1, cut // 128)):
            h = np.tanh(z[part] @ layers[0] + layers[1])
            error = (sigmoid(h @ layers[2] + layers[3]) - y[part]) / len(part)
            back = error[:, None] * layers[2] * (1 - h * h)
            grads = [z[part].T @ back, back.sum(axis=0), h.T @ error, error.sum(keepdims=True)]
            step([g + 1e-4 * p for g, p in zip(grads, layers, strict=True)])
    network = Network(mean, spread, tuple(layers), 1.0, 0.0)
    scale, shift = calibration(network.logits(x[cut:]), y[cut:], share)
    return Network(mean, spread, tuple(layers), scale, shift)


def _score(q: Quality, vectors, network: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(q.buckets)
        for batch in batches:
            x = [pooled(x, vectors.value) for x in texts_of(batch.column("text"), buckets)]
            score = network.scores(np.stack(x)) if x else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()),
                 pa.array((score >= q.threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, q: Quality = Quality()) -> DataFrame:
    """One row per document: doc_id, held_out, score (label 1 likelier when higher), predicted.

    The word vectors cover all texts. Labels come from rows that are not held out; of rows that repeat an id in
    ``labels`` the largest counts, null labels and ids are left out, and of its texts the largest by bytes is learned
    from. The scores don't depend on the partitions of the tables. Null and empty texts are scored as
    texts without words. With no usable labels, or one label only, every score is the share of label 1
    (one half without labels). Columns other than doc_id, text and quality are ignored.
    """
    spark = docs.sparkSession

    def learned(doc_id: Column) -> Column:
        return remainder(doc_id, q.fold) != q.held

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes().alias("text"))
    vectors = spark.sparkContext.broadcast(word_vectors(rows.select("text"), q))
    counts = labels.where(F.col("doc_id").isNotNull() & learned(F.col("doc_id").cast("long"))).agg(
        F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)
    ).first()
    share = counts[0] / sum(counts) if sum(counts) else 0.5
    chosen = labelled(labels, "quality", q.rows, learned)  # at most 2 x rows
    sample = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text"))
    # In the order of the ids: training must not depend on how the rows were spread.
    got = sorted(sample.mapInArrow(_features(q, vectors), "doc_id long, label int, x binary").collect())
    x = np.stack([np.frombuffer(r["x"]) for r in got]) if got else np.zeros((0, 2 * q.width + 1))
    network = fit(x, np.array([r["label"] for r in got], float), share, q)
    held = rows.select("doc_id", (~learned(F.col("doc_id"))).alias("held_out"), "text")
    return held.mapInArrow(
        _score(q, vectors, network), "doc_id long, held_out boolean, score double, predicted int"
    )
