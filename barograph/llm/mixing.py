"""Mixing to target weights: document rates by distributed projected-gradient least squares.

A classifier trained on labelled rows gives each document a posterior over domains, so a document belongs to
all domains in part. With x[d, k] = tokens[d] * posterior[d, k], the rates r >= 0 minimise

    sum over domains of (sum over d of r[d] * x[d, k] - target[k])^2

by projected gradient steps from r = 1. Changes of a rate are weighed by the document's tokens, so its
gradient is its posterior times the domains' residuals and long documents do not set the step. The steps add up to
one number per domain, r[d] = max(0, 1 - posterior[d] . moves), and are scaled by the Gram matrix of the rows above
zero. Each pass over the written table of x adds up the totals and that matrix; it goes on until each domain
meets its target, or no rates come closer. Nothing of a document leaves its task.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import REMEMBERED, U64, as_bytes, fresh
from .features import PARTS, adam

#: Domains, from the two labels of a row.
DOMAINS = ("clean", "low", "toxic")


@dataclass(frozen=True)
class Mixing:
    """shares: target tokens of each domain, as a multiple of what the documents hold of it.

    totals: target tokens of each domain instead. rows: labelled documents per domain learned from.
    close: the residual allowed in a domain, as a share of its target. steps: passes after which the fit fails.
    """

    shares: tuple[float, ...] = (1.0, 0.5, 0.25)
    totals: tuple[float, ...] | None = None
    buckets: int = 1 << 15
    rows: int = 1_500
    longest: int = 20_000
    epochs: int = 12
    steps: int = 1_000
    close: float = 1e-4
    seed: int = 3


LOW = (1 << 62) - 1


class Parts(dict):
    """A part's code: 62 bits of the hash of its lower case, one bit for capitals, one for symbols."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, part: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        kind = (part.isupper() and len(part) > 1) | (part[:1] in b"#*$%&|<>!") << 1
        code = self[part] = xxhash.xxh3_64_intdigest(part.lower()) & LOW | kind << 62
        return code


def features(data: bytes, known: Parts) -> np.ndarray:
    """Distinct hashed parts of a text, and marks of its form: capitals, repeats, symbols."""
    parts = PARTS.findall(data)
    codes = np.fromiter(map(known.__getitem__, parts), U64, len(parts))
    kind, low = codes >> U64(62), codes & U64(LOW)
    marks = []
    n = max(1, len(parts))
    for name, count in (
        (b"\x01capitals", np.count_nonzero(kind & U64(1))),
        (b"\x01repeats", np.count_nonzero(low[1:] == low[:-1])),
        (b"\x01symbols", np.count_nonzero(kind & U64(2))),
    ):
        marks += [known[name + str(level).encode()] & LOW for level in (5, 20, 50) if 100 * count > level * n]
    return np.unique(np.concatenate((low, np.array(marks, U64))) % U64(known.size)).astype(np.int64)


def train(texts: list[bytes], labels: np.ndarray, m: Mixing) -> np.ndarray:
    """Weights (buckets + 1) x domains of a multinomial logistic model over unit-length sets of features."""
    k = len(DOMAINS)
    weights = np.zeros((m.buckets + 1, k))
    if not len(labels):
        return weights
    known, rng = Parts(m.buckets), np.random.default_rng(m.seed)
    rows = [features(t, known) for t in texts]
    step = adam([weights], 0.05)
    balance = 1 / np.maximum(np.bincount(labels, minlength=k), 1)
    for _ in range(m.epochs):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 64)):
            grad = np.zeros_like(weights)
            for i in part:
                p = posterior(rows[i], weights)
                p[labels[i]] -= 1
                p *= balance[labels[i]] * len(rows) / k / len(part)
                grad[rows[i]] += p
                grad[-1] += p
            step([grad + 1e-4 * weights])
    return weights


def posterior(row: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = weights[row].sum(axis=0) + weights[-1]
    z = np.exp(z - z.max())
    return z / z.sum()


def _members(m: Mixing, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Parts(m.buckets)
        for batch in batches:
            tokens, members = [], []
            for data in batch.column(batch.schema.get_field_index("__text")):
                data = data.as_py()
                tokens.append(len(data.split()))
                members.append(posterior(features(data, known), weights.value).tolist())
            columns = [c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != "__text"]
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(tokens, pa.int64()), pa.array(members, pa.list_(pa.float64()))],
                names=[*names, "__tokens", "__members"],
            )

    return run


def domain(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of labelled rows: low quality first, then toxic, else clean; the worst of repeated ids."""
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    kind = F.when(F.col("quality") == 0, 1).when(F.col("toxic") == 1, 2).otherwise(0)
    return known.select("doc_id", kind.alias("label"))


#: Weights of the change of the rates beside the residuals; a smaller one follows where targets are not yet met.
DAMPING = (1e-4, 1e-7, 1e-10)


def rates(members: DataFrame, m: Mixing) -> tuple[Column, list[float], list[float]]:
    """The rate of a row as a column over __tokens and __members, the targets, and the totals at these rates.

    Warns where no rates reach the targets: the rates are then those of the least squares.
    """
    k = len(DOMAINS)
    tokens, p = F.col("__tokens"), [F.element_at("__members", i + 1) for i in range(k)]
    passes = 0

    def column(moves: np.ndarray) -> Column:
        r = F.greatest(F.lit(0.0), F.lit(1.0) - sum(F.lit(float(v)) * c for v, c in zip(moves, p, strict=True)))
        return F.when(tokens == 0, 1.0).otherwise(r)

    def look(moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Totals, Gram matrix of the rows above zero, and half the weighted squares of the rates."""
        nonlocal passes
        passes += 1
        r = F.col("__rate")
        free = F.when(r > 0, tokens)
        sums = [F.sum(r * tokens * c) for c in p] + [F.sum(free * a * b) for a in p for b in p]
        got = members.withColumn("__rate", column(moves)).agg(*sums, F.sum(tokens * r * r) / 2).first()
        got = np.array([v or 0.0 for v in got])
        return got[:k], got[k:-1].reshape(k, k), got[-1]

    moves = np.zeros(k)
    totals, gram, squares = look(moves)
    target = np.array(m.totals if m.totals is not None else totals * np.array(m.shares), float)
    whole = max(float(totals.max()), 1.0)
    allowed = m.close * np.maximum(target, max(1e-6 * float(target.max()), 1e-9))
    before = np.inf
    for damping in DAMPING:
        weight = damping * whole
        while True:
            slope = totals - target - weight * moves
            if (np.abs(slope) <= allowed / 4).all():
                break
            step = np.linalg.solve(gram + weight * np.eye(k), slope)
            value, gain, size = squares + moves @ target + weight * (moves @ moves) / 2, slope @ step, 1.0
            while size > 1e-9:
                if passes >= m.steps:
                    raise RuntimeError(f"rates not settled after {passes} passes: {totals.tolist()} for {target.tolist()}")
                after = moves + size * step
                seen = look(after)
                left = seen[0] - target - weight * after
                if seen[2] + after @ target + weight * (after @ after) / 2 <= value - 1e-4 * size * gain:
                    break
                if (np.abs(left) / allowed).max() <= (np.abs(slope) / allowed).max() / 2:
                    break
                size /= 2
            else:
                break  # no step is better: what is left is rounding
            moves, (totals, gram, squares) = after, seen
        residual = float((np.abs(totals - target) / allowed).max())
        if residual <= 1 or residual > before / 2:
            break
        before = residual
    if residual > 1:
        told = ", ".join(f"{d} {t:.0f} of {g:.0f}" for d, t, g in zip(DOMAINS, totals, target, strict=True))
        warnings.warn(f"no rates reach the target tokens: {told}", stacklevel=2)
    return column(moves), target.tolist(), totals.tolist()


def with_rates(docs: DataFrame, labels: DataFrame, m: Mixing = Mixing()) -> tuple[DataFrame, DataFrame]:
    """(rows of ``docs`` as a struct __row with __tokens, __members, __rate; the sums by domain as a table).

    The classifier learns from at most ``rows`` labelled documents per domain, of at most ``longest`` characters.
    Null and empty texts have no tokens, so no totals: their rate stays 1. Without labels all posteriors are
    equal. An empty table gives no rows and totals of zero.
    """
    spark = docs.sparkSession
    known = domain(labels)
    chosen = None
    for i in range(len(DOMAINS)):
        some = known.where(F.col("label") == i).orderBy(F.xxhash64("doc_id"), "doc_id").limit(m.rows)
        chosen = some if chosen is None else chosen.union(some)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes().alias("text"))
    sample = texts.where(F.length("text") <= m.longest).join(F.broadcast(chosen), "doc_id")  # at most 3 x rows
    got = sample.dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    weights = spark.sparkContext.broadcast(
        train([bytes(r["text"]) for r in got], np.array([r["label"] for r in got], int), m)
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    rows = docs.select(row, as_bytes().alias("__text"))
    schema = f"__row {rows.schema['__row'].dataType.simpleString()}, __tokens long, __members array<double>"
    members = rows.mapInArrow(_members(m, weights), schema)
    members = materialize(members, "mixing-members")
    rate, target, totals = rates(members, m)
    report = spark.createDataFrame(
        list(zip(DOMAINS, target, totals, strict=True)), "domain string, target double, expected double"
    )
    return members.withColumn("__rate", rate), report


def copies(rate: Column, doc_id: Column, text: Column) -> Column:
    """How often a document is taken: its rate, rounded up with the probability of its fraction, by hash."""
    share = F.pmod(F.xxhash64(doc_id, text), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + share).cast("int")


def mixed(docs: DataFrame, labels: DataFrame, m: Mixing = Mixing()) -> DataFrame:
    """``docs`` in the proportions asked for: a row with rate r comes r times on average, its columns unchanged.

    Rows with the same id and text share their draw, so copies stay or go together.
    """
    rows, _ = with_rates(docs, labels, m)
    n = copies(F.col("__rate"), F.col("__row.doc_id"), F.col("__row.text"))
    rows = rows.select("__row", n.alias("__copies"))
    again = F.explode(F.array_repeat(F.lit(1), F.col("__copies")))
    return rows.select("__row", again.alias("__one")).select("__row.*")


def document_rates(docs: DataFrame, labels: DataFrame, m: Mixing = Mixing()) -> DataFrame:
    """One row per document: doc_id, n_tokens, a posterior for each domain, rate and copies."""
    rows, _ = with_rates(docs, labels, m)
    name = fresh("p", [])
    return rows.select(
        F.col("__row.doc_id").alias("doc_id"), F.col("__tokens").alias("n_tokens"),
        *[F.element_at("__members", i + 1).alias(f"{name}_{d}") for i, d in enumerate(DOMAINS)],
        F.col("__rate").alias("rate"),
        copies(F.col("__rate"), F.col("__row.doc_id"), F.col("__row.text")).alias("copies"),
    )
