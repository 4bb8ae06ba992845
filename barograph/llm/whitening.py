"""Embedding whitening: covariance of distinct integer vectors, principal axes, unit variance along each.

Entries become whole numbers, x = floor(64 c) + 1,000,000, so equal vectors are equal without rounding.
Equal x vectors are grouped, and each distinct one enters the fit with a weight: one, or the number of its rows.
Sums per dimension are exact (whole numbers in two halves). The covariance is a weighted product of centred
vectors: each task multiplies its rows, centred first, and the matrices are added row by row of the matrix. The
mean is split into a whole and a fraction, so that centring loses no digits to the offset of a million.

The driver holds sums and matrices of one vector length only, whatever the number of rows. Each distinct vector is
whitened once, and the rows of the table, however many share a vector, take their result by a join on x.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Entries of larger size have no x that fits a 64-bit sum.
LARGEST = float(1 << 52)
#: Rows of vectors that are multiplied at a time.
ROWS = 4096


@dataclass(frozen=True)
class Whitening:
    """Components kept, and the weight of a distinct vector: "one", or "counts" for the number of its rows.

    Components with less than ``floor`` of the largest eigenvalue hold rounding only and are left out.
    """

    components: int = 16
    weights: str = "one"
    floor: float = 1e-13


@dataclass(frozen=True)
class Axes:
    """The fit for one vector length: total weight, whole and fractional mean, remainder, projection, shares."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    project: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum of (n x - S)^2, exact; null beyond 64 bits."""
        y = self.n * (x - self.whole) - self.rest
        rough = self.n * (x - self.whole).astype(np.float64) - self.rest
        fits = (rough * rough).sum(axis=1) < 9.2e18
        return pa.array((y * y).sum(axis=1), pa.int64(), mask=~fits)


def whole_numbers(vector: str = "embedding") -> Column:
    """x of a vector column; null for vectors that are null, empty, or hold null, non-finite or huge entries."""
    number = F.col(vector).cast("array<double>")
    bad = F.exists(number, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > F.lit(LARGEST)))
    x = F.transform(number, lambda c: F.floor(c * 64).cast("long") + F.lit(1_000_000).cast("long"))
    return F.when((F.size(number) > 0) & ~bad, x)


def matrices(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, their vectors as a matrix), at most ``ROWS`` rows of one vector length at a time."""
    for batch in batches:
        sizes = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
        for width in np.unique(sizes):
            some = batch if (sizes == width).all() else batch.take(pa.array(np.flatnonzero(sizes == width)))
            for at in range(0, some.num_rows, ROWS):
                part = some.slice(at, ROWS)
                flat = part.column(column).flatten().to_numpy(zero_copy_only=False)
                yield part, flat.reshape(part.num_rows, width)


SUMS = "width int, place int, weight long, high long, low long"


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task's vectors per dimension, of the upper and the lower 32 bits of each entry."""
    total: dict[int, list] = {}
    for part, x in matrices(batches):
        weight = part.column(1).to_numpy(zero_copy_only=False)
        high = x >> 32
        new = [int(weight.sum()), weight @ high, weight @ (x - (high << 32))]
        old = total.get(x.shape[1], [0, 0, 0])
        total[x.shape[1]] = [a + b for a, b in zip(old, new, strict=True)]
    for width, (weight, high, low) in total.items():
        same = np.full(width, width, np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(same), pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, weight)), pa.array(high),
             pa.array(low)], names=["width", "place", "weight", "high", "low"],
        )


PRODUCTS = "width int, place int, products array<double>"


def _rows_of(total: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for width, matrix in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(matrix), width, np.int32)), pa.array(np.arange(len(matrix), dtype=np.int32)),
             pa.array(list(matrix), pa.list_(pa.float64()))], names=["width", "place", "products"],
        )


def _products(axes: dict[int, Axes] | None):
    """Weighted products of a task's vectors, centred first (those already whitened are centred by the caller)."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for part, x in matrices(batches):
            weight = part.column(1).to_numpy(zero_copy_only=False)
            y = axes[x.shape[1]].centred(x) if axes else x
            total[x.shape[1]] = total.get(x.shape[1], 0) + y.T @ (weight[:, None] * y)
        yield from _rows_of(total)

    return products


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the matrix rows that came to this task; it holds one sum per matrix row."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        lists = batch.column(2)
        for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            total[key] = total.get(key, 0) + lists[i].values.to_numpy(zero_copy_only=False)
    if total:
        widths, places = zip(*total, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(widths, pa.int32()), pa.array(places, pa.int32()),
             pa.array(list(total.values()), pa.list_(pa.float64()))], names=["width", "place", "products"],
        )


def covariances(rows: DataFrame, axes: dict[int, Axes] | None) -> dict[int, np.ndarray]:
    """Sum of weight * y y^T by vector length, over rows of (vector, weight)."""
    parts = rows.mapInArrow(_products(axes), PRODUCTS).repartition("width", "place").mapInArrow(_added, PRODUCTS)
    out: dict[int, dict[int, list]] = {}
    for row in parts.toLocalIterator():
        out.setdefault(row["width"], {})[row["place"]] = row["products"]
    return {width: np.array([found[i] for i in range(len(found))]) for width, found in out.items()}


def fitted(classes: DataFrame, whitening: Whitening) -> dict[int, Axes]:
    """The axes by vector length, from distinct vectors (x, weight)."""
    sums = classes.mapInArrow(_sums, SUMS).groupBy("width", "place").agg(
        F.sum("weight").alias("weight"), F.sum("high").alias("high"), F.sum("low").alias("low")
    )
    by_width: dict[int, list] = {}
    for row in sums.collect():  # one row per dimension
        by_width.setdefault(row["width"], []).append((row["place"], row["weight"], (row["high"] << 32) + row["low"]))
    axes = {}
    for width, found in by_width.items():
        found.sort()
        n = found[0][1]
        split = [divmod(total, n) for _, _, total in found]
        whole, rest = (np.array(part, np.int64) for part in zip(*split, strict=True))
        axes[width] = Axes(n, whole, rest, np.empty((width, 0)), np.empty(0))
    for width, matrix in covariances(classes, axes).items():
        one = axes[width]
        values, vectors = np.linalg.eigh((matrix + matrix.T) / 2 / one.n)
        values, vectors = values[::-1], vectors[:, ::-1]
        some = np.flatnonzero(values > max(values[0], 0) * whitening.floor)[: whitening.components]
        share = values[some] / values.sum() if len(some) else np.empty(0)
        axes[width] = Axes(one.n, one.whole, one.rest, vectors[:, some] / np.sqrt(values[some]), share)
    return axes


WHITE = "x array<long>, weight long, deviation long, white array<double>"


def _whitened(axes: dict[int, Axes]):
    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches):
            one = axes[x.shape[1]]
            white = one.centred(x) @ one.project
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), one.deviation(x), pa.array(list(white), pa.list_(pa.float64()))],
                names=["x", "weight", "deviation", "white"],
            )

    return whitened


def _identity_errors(white: DataFrame, axes: dict[int, Axes]) -> dict[int, float]:
    """Largest entry of |covariance of the whitened fit list - identity| by vector length."""
    width = F.size("x").alias("width")
    k = max((len(a.explained) for a in axes.values()), default=0)
    if not k:
        return {}
    means = white.groupBy(width).agg(
        F.sum("weight").alias("n"), *[F.sum(F.try_element_at("white", F.lit(i + 1)) * F.col("weight")).alias(f"m{i}") for i in range(k)]
    )
    errors = {}
    for row in means.collect():  # one row per vector length
        some = len(axes[row["width"]].explained)
        if some:
            mean = F.array(*[F.lit(row[f"m{i}"] / row["n"]) for i in range(some)])
            centred = F.zip_with("white", mean, lambda a, m: a - m)
            rows = white.where(F.size("x") == row["width"]).select(centred.alias("y"), "weight")
            matrix = covariances(rows, None)[some] / row["n"]
            errors[row["width"]] = float(np.abs(matrix - np.eye(some)).max())
    return errors


def whiten(rows: DataFrame, whitening: Whitening = Whitening()) -> DataFrame:
    """One row per row of ``rows`` and component: vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error.

    ``rows`` has vec_id and embedding; other columns are ignored. Rows whose vector is null, empty, or holds null,
    non-finite or huge entries (beyond 2^52) are dropped; null and repeated ids stay, each row with its own
    result. Vectors of different lengths are fitted apart. There are no more components than the covariance has
    eigenvalues above rounding, so a single distinct vector has none, and its rows are absent. ``deviation`` is null
    where it doesn't fit into 64 bits. An empty table gives no rows.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers().alias("x")).where("x is not null")
    classes = materialize(rows.groupBy("x").agg(F.count("*").alias("rows")).select(
        "x", F.col("rows").alias("weight") if whitening.weights == "counts" else F.lit(1).cast("long").alias("weight")
    ), "whitening-classes")
    axes = fitted(classes, whitening)
    white = materialize(classes.mapInArrow(_whitened(axes), WHITE), "whitening-white")
    errors = _identity_errors(white, axes)

    def by_width(value, kind: str) -> Column:
        start = F.lit(None).cast(kind)
        return reduce(lambda c, w: F.when(F.size("x") == w, F.lit(value(w)).cast(kind)).otherwise(c), axes, start)

    of = white.select(
        "x", "deviation", "white", by_width(lambda w: axes[w].n, "long").alias("n"),
        by_width(lambda w: axes[w].explained.tolist(), "array<double>").alias("explained"),
        by_width(lambda w: errors.get(w), "double").alias("identity_error"),
    )
    joined = rows.join(of, "x").select(
        "vec_id", F.posexplode(F.arrays_zip(F.col("white"), F.col("explained"))).alias("place", "one"), "n", "deviation",
        "identity_error",
    )
    return joined.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", F.col("one.white").alias("whitened"),
        F.col("one.explained").alias("explained"), "identity_error",
    )
