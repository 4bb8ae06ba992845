"""Isolation forest: bounded samples build the trees, all rows are scored."""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barograph.functions.columns import flag
from barograph.operators.anomaly import mean_impute
from barograph.params import ForestParams, SeriesSpec
from barograph.plans.layout import BLOCK, POS, attach, exact_quantile, series_sizes, split_blocks, spread
from barograph.session import materialize

EULER_GAMMA = 0.5772156649015329
_SCORE_ROWS = 16_384
_NODE_FIELDS = ("feature", "threshold", "left", "value")


def mean_path(rows: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``rows`` rows."""
    rows = np.asarray(rows, float)
    many = np.maximum(rows, 3.0)
    length = 2.0 * (np.log(many - 1.0) + EULER_GAMMA) - 2.0 * (many - 1.0) / many
    return np.where(rows > 2, length, np.where(rows == 2, 1.0, 0.0))


def grow_forest(x: np.ndarray, samples: np.ndarray, rng: np.random.Generator, max_depth: int) -> dict[str, np.ndarray]:
    """Grow all trees level by level; tree ``t`` starts at node ``t``.

    Inner nodes hold a random feature and a random threshold in its range; the right
    child comes after the left one. A leaf has feature -1 and holds its path length.
    """
    trees, size = samples.shape
    nodes = {"feature": [], "threshold": [], "left": [], "value": []}
    rows, node, next_id = samples.ravel(), np.repeat(np.arange(trees), size), trees
    for depth in range(max_depth + 1):
        if not len(rows):
            break
        order = np.argsort(node, kind="stable")
        rows, node = rows[order], node[order]
        ids, starts, counts = np.unique(node, return_index=True, return_counts=True)
        values = x[rows]
        low, high = np.minimum.reduceat(values, starts, axis=0), np.maximum.reduceat(values, starts, axis=0)
        uneven = high > low
        splits = uneven.any(axis=1) & (depth < max_depth)
        feature = np.argmax(rng.random(uneven.shape) * uneven, axis=1)
        at = np.arange(len(ids))
        bottom, top = low[at, feature], high[at, feature]
        # Below the top even where rounding would reach it: a split leaves rows on both sides.
        threshold = np.minimum(bottom + rng.random(len(ids)) * (top - bottom), np.nextafter(top, bottom))
        left = next_id + 2 * (np.cumsum(splits) - 1)
        next_id += 2 * int(splits.sum())
        nodes["feature"].append(np.where(splits, feature, -1))
        nodes["threshold"].append(np.where(splits, threshold, 0.0))
        nodes["left"].append(np.where(splits, left, ids))
        nodes["value"].append(np.where(splits, 0.0, depth + mean_path(counts)))
        mine = np.repeat(at, counts)
        goes_left = values[np.arange(len(rows)), feature[mine]] <= threshold[mine]
        kept = splits[mine]
        node = np.where(goes_left, left[mine], left[mine] + 1)[kept]
        rows = rows[kept]
    return {name: np.concatenate(parts) for name, parts in nodes.items()}


#: The hash that deals rows to trees works modulo this prime, so that its squares fit 64 bits.
PRIME = 2**31 - 1


def tree_hash(pos: Column | str, tree: Column, seed: int) -> Column:
    """A number below ``PRIME`` for each row and tree: two rounds of squaring, plain arithmetic."""
    pos = F.col(pos) if isinstance(pos, str) else pos
    one = (pos % PRIME * 48271 + tree * 69621 + seed) % PRIME
    two = (one * one + tree * 16807 + pos) % PRIME
    return (two * two + one) % PRIME


def tree_samples(df: DataFrame, spec: SeriesSpec, params: ForestParams = ForestParams()) -> DataFrame:
    """The rows of each tree: the ``sample_rows`` of the series with the smallest hashes, ties to the earlier row.

    ``df`` has ``n``, the rows of the series; ``tree`` and ``place`` (in the order of the hashes) are added. Every row may
    be drawn by every tree. A row is sent to the trees whose hash is so small that about twice as many rows as wanted
    come together; should too few come for any tree, its series is drawn again from all rows.
    """
    keys, wanted = list(spec.keys), params.sample_rows
    trees = F.sequence(F.lit(0).cast("long"), F.lit(params.trees - 1).cast("long"))

    def drawn(rows: DataFrame, cut: Column) -> DataFrame:
        # A row per tree lives in the task's loop only: what the filter drops is never stored.
        each = rows.withColumn("_cut", cut).withColumn("tree", F.explode(trees))
        near = each.withColumn("_hash", tree_hash(POS, F.col("tree"), params.seed)).filter(F.col("_hash") < F.col("_cut"))
        near = near.drop("_cut")
        first = Window.partitionBy(*keys, "tree").orderBy("_hash", POS)
        # About twice the wanted rows in a group.
        return near.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= wanted).drop("_hash")

    share = F.least(F.lit(1.0), F.lit(2.0 * wanted + 64) / F.col("n"))
    found = materialize(drawn(df, F.ceil(share * PRIME)), "forest-samples")
    sizes = found.groupBy(*keys, "n").agg(F.count("*").alias("_drawn"))
    short = sizes.filter(F.col("_drawn") < params.trees * F.least(F.lit(wanted).cast("long"), "n")).select(*keys)
    if short.isEmpty():
        return found
    again = attach(df.drop("n"), series_sizes(df, spec).join(short, keys, "left_semi"), spec).select(*df.columns)
    return found.join(short, keys, "left_anti").unionByName(drawn(again, F.lit(PRIME)))


def _depth(sample: int) -> int:
    return int(np.ceil(np.log2(max(sample, 2))))


def _seed_of(seed: int, key: tuple) -> list[int]:
    return [seed, *[int.from_bytes(blake2b(str(k).encode(), digest_size=8).digest(), "little") for k in key]]


def forest_scores(x: np.ndarray, forest: dict[str, np.ndarray], trees: int, sample: float, depth: int) -> np.ndarray:
    """Anomaly score of each row: 2 to the power of minus the mean relative path length.

    The right child follows the left one, and a leaf is its own left child behind an
    infinite threshold, so one step is the same for inner nodes and leaves.
    """
    if sample <= 1:
        return np.full(len(x), 0.5)
    leaf = forest["feature"] < 0
    feature = np.where(leaf, 0, forest["feature"])
    threshold = np.where(leaf, np.inf, forest["threshold"])
    total = np.zeros(len(x))
    for i in range(0, len(x), _SCORE_ROWS):
        part = x[i : i + _SCORE_ROWS]
        cells, start = part.ravel(), np.arange(len(part)) * part.shape[1]
        for tree in range(trees):
            at = np.full(len(part), tree)
            for _ in range(depth):
                at = forest["left"].take(at) + (cells.take(start + feature.take(at)) > threshold.take(at))
            total[i : i + _SCORE_ROWS] += forest["value"].take(at)
    return np.exp2(-total / trees / float(mean_path(sample)))


def isolation_scores(
    df: DataFrame, spec: SeriesSpec, columns: Iterable[str], params: ForestParams = ForestParams()
) -> DataFrame:
    """Keys, position and ``score`` in (0, 1]; higher is more isolated. One forest per series key.

    Nulls are replaced by the mean of the series. Each tree is built on its own sample of the whole series
    (``tree_samples``); together they are at most trees x sample rows, whatever the series' length.
    Scoring runs per block: the packed forest of a series meets each of its blocks.
    """
    columns = list(columns)
    work = [f"_f_{c}" for c in columns]
    numbers = [F.col(c).cast("double").alias(f) for c, f in zip(columns, work)]
    inputs = mean_impute(df.select(*spec.keys, POS, *numbers), spec, work)
    pool = tree_samples(attach(inputs, series_sizes(inputs, spec), spec), spec, params)
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in spec.keys)
    forest_schema = (
        f"{key_schema}, n long, sample long, trees long, feature array<int>, threshold array<double>, "
        "left array<int>, value array<double>"
    )

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tree", "place"])
        x = np.nan_to_num(pdf[work].to_numpy(float))
        key = tuple(pdf[k].iloc[0] for k in spec.keys)
        rng = np.random.default_rng(_seed_of(params.seed, key))
        sample = len(x) // params.trees
        depth = _depth(sample)
        forest = grow_forest(x, np.arange(len(x)).reshape(params.trees, sample), rng, depth)
        row = dict(zip(spec.keys, key)) | {"n": int(pdf["n"].iloc[0]), "sample": sample, "trees": params.trees}
        row |= {name: forest[name].tolist() for name in _NODE_FIELDS}
        return pd.DataFrame([row])

    forests = spread(pool, spec.keys).groupBy(*spec.keys).applyInPandas(build, forest_schema)
    blocks = split_blocks(inputs, spec).drop("_own")
    if spec.one_block:
        forests = forests.withColumn(BLOCK, F.lit(0).cast("long"))
    else:
        # Every block needs the forest; it is built once and not once per block.
        forests = materialize(forests, "forests")
        count = F.expr(f"(n - 1) div {spec.block_rows}")
        forests = forests.withColumn(BLOCK, F.explode(F.sequence(F.lit(0).cast("long"), count)))
    schema = f"{key_schema}, {POS} long, score double"

    def score(rows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        out = rows[[*spec.keys, POS]].copy()
        if model.empty or rows.empty:
            out["score"] = np.nan
            return out
        m = model.iloc[0]
        forest = {name: np.asarray(m[name]) for name in _NODE_FIELDS}
        x = np.nan_to_num(rows[work].to_numpy(float))
        out["score"] = forest_scores(x, forest, int(m["trees"]), float(m["sample"]), _depth(int(m["sample"])))
        return out

    keys = [*spec.keys, BLOCK]
    return spread(blocks, keys).groupBy(*keys).cogroup(spread(forests, keys).groupBy(*keys)).applyInPandas(score, schema)


def isolation_flags(
    df: DataFrame,
    spec: SeriesSpec,
    columns: Iterable[str],
    params: ForestParams = ForestParams(),
    name: str = "anomaly_iforest",
) -> DataFrame:
    """Flag the rows scoring above the exact (1 - contamination) quantile of their series."""
    # Scores are read three times (histogram, cut, flags): write them down once.
    scored = materialize(isolation_scores(df, spec, columns, params), "scores")
    cuts = exact_quantile(scored, spec.keys, "score", 1.0 - params.contamination)
    cuts = series_sizes(scored, spec).join(cuts, list(spec.keys))
    marked = attach(scored, cuts, spec).select(*spec.keys, POS, flag(F.col("score") > F.col("cut")).alias(name))
    return df.join(marked, [*spec.keys, POS]).select(*df.columns, name)
