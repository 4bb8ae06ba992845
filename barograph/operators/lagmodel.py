"""Multivariate forecaster on lag windows: ridge regression for all sensors at once.

The regression explains the change from the row before, so a strong penalty leans
towards the last reading and not towards the mean. The penalty of each sensor is
the one with the least error on the held-out rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.scaling import scale_limits, scaled, unscaled
from barograph.params import ForecastParams, SeriesSpec
from barograph.plans.layout import BLOCK, OWN, POS, attach, block_window, merge_blocks, split_blocks, spread
from barograph.session import materialize

RIDGES = (1e-4, 1e-3, 1e-2, 1e-1)
TRAIN_SHARE = 0.8
MIN_WINDOWS = 10
_GROUP = "_group"
_FINAL_PARTS = 32


@dataclass(frozen=True)
class LagModel:
    """Coefficients (intercept, then lags in row order) of the change of each target column."""

    columns: tuple[str, ...]
    lookback: int
    coefficients: np.ndarray
    validation_rmse: dict[str, float]

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (c, self.lookback, self.coefficients[:, i].tolist(), self.validation_rmse.get(c))
            for i, c in enumerate(self.columns)
        ]
        schema = "target string, lookback long, coefficients array<double>, validation_rmse double"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, columns: Iterable[str]) -> LagModel:
        columns = tuple(columns)
        rows = {r["target"]: r for r in spark.read.parquet(path).filter(F.col("target").isin(*columns)).collect()}
        return LagModel(
            columns,
            rows[columns[0]]["lookback"],
            np.array([rows[c]["coefficients"] for c in columns]).T,
            {c: rows[c]["validation_rmse"] for c in columns},
        )


def lag_windows(
    df: DataFrame, spec: SeriesSpec, columns: Iterable[str], lookback: int, horizon: int = 1
) -> DataFrame:
    """Add ``lags`` (the ``lookback`` rows before) and ``targets`` (this row and the next).

    Both are flat arrays in row order; rows without a full window on both sides
    are dropped.
    """
    row = F.array(*[F.col(c).cast("double") for c in columns])
    blocks = split_blocks(df, spec, before=lookback, after=horizon - 1)
    w = block_window(spec)
    blocks = blocks.withColumns(
        {
            "lags": F.collect_list(row).over(w.rowsBetween(-lookback, -1)),
            "targets": F.collect_list(row).over(w.rowsBetween(0, horizon - 1)),
        }
    )
    full = merge_blocks(blocks, spec).filter((F.size("lags") == lookback) & (F.size("targets") == horizon))
    return full.withColumns({"lags": F.flatten("lags"), "targets": F.flatten("targets")})


def _scaled_rows(df: DataFrame, spec: SeriesSpec, columns: list[str], plan: DataFrame) -> DataFrame:
    """Rows with ``_z_<column>``, scaled by the range seen before the forecast start."""
    planned = attach(df.select(*spec.keys, POS, *columns), plan.select(*spec.keys, "n", "start"), spec)
    limits = scale_limits(planned, spec, columns, F.col(POS) < F.col("start"))
    rows = attach(planned.drop("n"), limits, spec)
    return rows.withColumns({f"_z_{c}": scaled(c) for c in columns})


def _windows(pdf: pd.DataFrame, columns: list[str], lookback: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row numbers, lag matrix, change from the row before) of owned rows with a full, gap-free window.

    Rows come in block and position order; a window must not cross a block.
    """
    z = pdf[[f"_z_{c}" for c in columns]].to_numpy(float)
    if len(z) <= lookback:
        return np.empty(0, int), np.empty((0, lookback * len(columns))), np.empty((0, len(columns)))
    pos, group = pdf[POS].to_numpy(), pdf[_GROUP].to_numpy()
    lags = np.lib.stride_tricks.sliding_window_view(z, lookback, axis=0)[:-1].transpose(0, 2, 1)
    usable = pdf[OWN].to_numpy(bool)[lookback:] & (pos[lookback:] - pos[:-lookback] == lookback)
    usable &= (group[lookback:] == group[:-lookback]) & ~np.isnan(lags).any(axis=(1, 2))
    usable &= ~np.isnan(z[lookback:]).any(axis=1)
    at = np.flatnonzero(usable)
    return at + lookback, lags[at].reshape(len(at), lookback * len(columns)), z[at + lookback] - z[at + lookback - 1]


def _add_up(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sum the matrices of all rows of a partition, one batch at a time."""
    train = held = None
    rows = 0
    for batch in parts:
        for a, b, n in zip(batch["train"], batch["held"], batch["rows"]):
            a, b = np.frombuffer(a), np.frombuffer(b)
            train, held = (a, b) if train is None else (train + a, held + b)
            rows += int(n)
    if train is not None:
        yield pd.DataFrame({"train": [train.tobytes()], "held": [held.tobytes()], "rows": [rows]})


def fit_lag_model(
    df: DataFrame, spec: SeriesSpec, columns: Iterable[str], plan: DataFrame, params: ForecastParams = ForecastParams()
) -> LagModel | None:
    """Fit on the rows before the forecast start; the last fifth of them validates.

    One pass: every task adds up the cross products of its windows while it reads
    its sorted blocks, a few tasks merge these sums, and the driver solves one small
    system whose size depends on lookback and sensors only. ``None`` below ten
    windows.
    """
    columns = list(columns)
    lookback, k = params.lookback, len(columns)
    width = 1 + lookback * k + k
    rows = _scaled_rows(df, spec, columns, plan).filter(F.col(POS) < F.col("start"))
    group = F.xxhash64(*spec.keys, BLOCK).alias(_GROUP)
    blocks = split_blocks(rows, spec, before=lookback)
    blocks = blocks.select(group, OWN, POS, "start", *[f"_z_{c}" for c in columns])
    schema = "train binary, held binary, rows long"

    def cross_products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        train, held, rows = np.zeros((width, width)), np.zeros((width, width)), 0
        before = None
        for batch in batches:
            # The last rows of a batch are the lags of the first rows of the next.
            pdf = batch if before is None else pd.concat([before, batch], ignore_index=True)
            before = pdf.iloc[-lookback:].assign(**{OWN: False})
            at, lags, changes = _windows(pdf, columns, lookback)
            early = pdf[POS].to_numpy()[at] < np.floor(pdf["start"].to_numpy()[at] * TRAIN_SHARE)
            m = np.hstack([np.ones((len(at), 1)), lags, changes])
            train += m[early].T @ m[early]
            held += m[~early].T @ m[~early]
            rows += int(early.sum())
        yield pd.DataFrame({"train": [train.tobytes()], "held": [held.tobytes()], "rows": [rows]})

    parts = spread(blocks, [_GROUP]).sortWithinPartitions(_GROUP, POS).mapInPandas(cross_products, schema)
    merged = parts.repartition(_FINAL_PARTS).mapInPandas(_add_up, schema).collect()  # one row per part
    if sum(r["rows"] for r in merged) < MIN_WINDOWS:
        return None
    train = sum(np.frombuffer(r["train"]) for r in merged).reshape(width, width)
    held = sum(np.frombuffer(r["held"]) for r in merged).reshape(width, width)
    inputs = width - k
    penalty = train[0, 0] * np.eye(inputs)
    penalty[0, 0] = 0.0
    options = [np.linalg.solve(train[:inputs, :inputs] + r * penalty, train[:inputs, inputs:]) for r in RIDGES]

    def held_out_rmse(beta: np.ndarray, i: int) -> float:
        v = np.concatenate([beta[:, i], -np.eye(k)[i]])
        return float(np.sqrt(max(v @ held @ v, 0.0) / held[0, 0])) if held[0, 0] else float("nan")

    beta, quality = np.empty((inputs, k)), {}
    for i, c in enumerate(columns):
        errors = [held_out_rmse(option, i) for option in options]
        best = int(np.argmin(np.nan_to_num(errors)))
        beta[:, i], quality[c] = options[best][:, i], errors[best]
    return LagModel(tuple(columns), lookback, beta, quality)


def lag_forecast(
    df: DataFrame,
    spec: SeriesSpec,
    columns: Iterable[str],
    plan: DataFrame,
    params: ForecastParams = ForecastParams(),
    model: LagModel | None = None,
) -> DataFrame:
    """``<column>_forecast`` for every position from ``start`` on."""
    columns = list(columns)
    model = model or fit_lag_model(df, spec, columns, plan, params)
    if model is None:
        nothing = df.select(*spec.keys, POS).limit(0)
        return nothing.withColumns({f"{c}_forecast": F.lit(None).cast("double") for c in columns})
    lookback, beta = model.lookback, model.coefficients
    rows = _scaled_rows(df, spec, columns, plan).filter(F.col(POS) >= F.col("start") - lookback)
    limits = [f"{c}_{end}" for c in columns for end in ("low", "high")]
    blocks = split_blocks(rows, spec, before=lookback).drop(*columns, "n").withColumn(_GROUP, F.lit(0))
    keys = [f for f in df.schema.fields if f.name in spec.keys]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys)
    schema += f", {POS} long, start long, " + ", ".join(f"`{c}` double" for c in [*limits, *[f"_p_{c}" for c in columns]])

    def predict(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(POS)
        at, lags, _ = _windows(pdf, columns, lookback)
        out = pdf.iloc[at][[*spec.keys, POS, "start", *limits]].reset_index(drop=True)
        last = lags[:, lags.shape[1] - len(columns) :]
        out[[f"_p_{c}" for c in columns]] = last + beta[0] + lags @ beta[1:]
        return out

    predicted = blocks.groupBy(*spec.keys, BLOCK).applyInPandas(predict, schema).filter(F.col(POS) >= F.col("start"))
    return predicted.select(*spec.keys, POS, *[unscaled(F.col(f"_p_{c}"), c).alias(f"{c}_forecast") for c in columns])


def rolling_lag_forecast(
    df: DataFrame, spec: SeriesSpec, columns: Iterable[str], plan: DataFrame, params: ForecastParams = ForecastParams()
) -> DataFrame:
    """``<column>_forecast`` from the first origin on, by models that saw at least half the rows before.

    The first origin is ``start``, or where a series alone has ten windows to train on. The model is fitted anew at
    twice, four times and so on the first origin, on the rows before that only, and forecasts up to the
    next one. All fits together read two to three times the rows.
    """
    columns = list(columns)
    least = math.ceil((params.lookback + MIN_WINDOWS) / TRAIN_SHARE)
    df = materialize(df, "lag-rows")
    plan = materialize(plan.withColumn("start", F.greatest("start", F.lit(least).cast("long"))), "lag-plan")
    most = plan.agg(F.max(F.col("n") / F.col("start"))).first()[0]
    parts = []
    for i in range(max(1, math.ceil(math.log2(most or 1)))):
        seen = plan.withColumn("_until", F.col("start") * (2 << i))
        seen = seen.withColumn("start", F.least("n", F.col("start") * (1 << i)))
        rows = attach(df, seen.select(*spec.keys, "n", "_until"), spec).filter(F.col(POS) < F.col("_until"))
        parts.append(lag_forecast(rows.drop("n", "_until"), spec, columns, seen.drop("_until"), params))
    return reduce(DataFrame.unionByName, parts)
