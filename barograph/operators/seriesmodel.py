"""One lag model per series: ridge regression of a reading's change on the readings before it.

A block of a series is reduced to the count, mean and centred cross products of its windows, and these merge
exactly, so a long series is fitted by many tasks. The penalty is a share of each lag's own variance, so a model
doesn't depend on the unit of its sensor.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.params import SeriesSpec
from barograph.plans.layout import BLOCK, OWN, POS, attach, split_blocks, spread


@dataclass(frozen=True)
class SeriesModelParams:
    """Lags, ridge share, and the last rows before the forecast start that are fitted (0: all of them)."""

    lookback: int = 48
    ridge: float = 1e-2
    train_rows: int = 0
    min_windows: int = 10


@dataclass(frozen=True)
class SeriesModels:
    """Models by series: keys, sensor, intercept, coefficients (oldest lag first)."""

    table: DataFrame
    lookback: int


def windows(values: np.ndarray, pos: np.ndarray, lookback: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, lags) of the rows behind ``lookback`` rows without a gap; rows come in position order."""
    if len(values) <= lookback:
        return np.empty(0, int), np.empty((0, lookback))
    lags = np.lib.stride_tricks.sliding_window_view(values, lookback)[:-1]
    at = np.flatnonzero((pos[lookback:] - pos[:-lookback] == lookback) & ~np.isnan(lags).any(axis=1))
    return at + lookback, lags[at]


def merged(parts: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, mean and centred products of all parts together."""
    n, mean, products = 0, None, None
    for m, other, more in parts:
        if n == 0:
            n, mean, products = m, other, more
        elif m:
            step = other - mean
            products = products + more + np.outer(step, step) * (n * m / (n + m))
            mean = mean + step * (m / (n + m))
            n += m
    return n, mean, products


def solve(n: int, mean: np.ndarray, products: np.ndarray, ridge: float) -> tuple[float, np.ndarray, float]:
    """(intercept, coefficients, root mean square of what is left) from windows with the change as last entry."""
    c = products / n
    inputs = c[:-1, :-1] + ridge * np.diag(np.diag(c)[:-1])
    live = np.diag(inputs) > 0  # a lag that never changes explains nothing
    beta = np.zeros(len(mean) - 1)
    if live.any():
        beta[live] = np.linalg.lstsq(inputs[np.ix_(live, live)], c[:-1, -1][live], rcond=None)[0]
    left = np.append(-beta, 1.0)
    return float(mean[-1] - beta @ mean[:-1]), beta, float(np.sqrt(max(left @ c @ left, 0.0)))


def _keys(df: DataFrame, spec: SeriesSpec) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{k}` {types[k]}" for k in spec.keys)


def _sensor(spec: SeriesSpec, columns: list[str], names: list[str]) -> tuple[bool, list[str]]:
    """Whether a column of its own names the sensor, and the names."""
    wide = "sensor" not in spec.keys
    if not wide and len(columns) != 1:
        raise ValueError("series by sensor have one value column")
    return wide, names


def fit_series_models(
    df: DataFrame,
    spec: SeriesSpec,
    columns: Iterable[str],
    plan: DataFrame,
    params: SeriesModelParams = SeriesModelParams(),
    names: Iterable[str] | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """Models (keys, sensor, windows, intercept, coefficients, rmse) from the rows before ``start`` of each series.

    ``plan`` has the keys, ``n`` and ``start``. ``only`` lists the series to fit, by keys and sensor: no row
    of other series is read into a fit. Without "sensor" among the keys there is one model per column, with its name from ``names``. Series
    with fewer than ``min_windows`` full windows have no model.
    """
    columns = list(columns)
    wide, names = _sensor(spec, columns, list(names or columns))
    if only is not None:
        plan = plan.join(only.select(*spec.keys).distinct(), list(spec.keys), "left_semi")
    rows = attach(df.select(*spec.keys, POS, *columns), plan.select(*spec.keys, "n", "start"), spec)
    rows = rows.filter(F.col(POS) < F.col("start"))
    if params.train_rows:
        rows = rows.filter(F.col(POS) >= F.col("start") - params.train_rows - params.lookback)
    blocks = split_blocks(rows.drop("n", "start"), spec, before=params.lookback)
    kinds, keys = _keys(df, spec), list(spec.keys)
    label = ", sensor string" if wide else ""

    def reduce(table: pa.Table) -> pa.Table:
        table = table.sort_by(POS)
        pos, own = table.column(POS).to_numpy(), table.column(OWN).to_numpy(zero_copy_only=False)
        found = []
        for c in columns:
            x = table.column(c).to_numpy().astype(float)
            at, lags = windows(x, pos, params.lookback)
            some = own[at] & ~np.isnan(x[at])
            at, lags = at[some], lags[some]
            m = np.column_stack((lags, x[at] - x[at - 1]))
            mean = m.mean(axis=0) if len(m) else np.zeros(params.lookback + 1)
            found.append((len(m), mean.tobytes(), ((m - mean).T @ (m - mean)).tobytes()))
        return _rows(table, found, ["windows", "mean", "products"])

    def _rows(table: pa.Table, found: list[tuple], fields: list[str]) -> pa.Table:
        out = table.slice(0, 1).select(keys).take([0] * len(found))
        if wide:
            out = out.append_column("sensor", pa.array(names))
        for field, values in zip(fields, zip(*found, strict=True), strict=True):
            out = out.append_column(field, pa.array(values))
        return out

    def fit(table: pa.Table) -> pa.Table:
        width = params.lookback + 1
        parts = zip(*(table.column(c).to_pylist() for c in ("windows", "mean", "products")), strict=True)
        n, mean, products = merged((n, np.frombuffer(a), np.frombuffer(b).reshape(width, width)) for n, a, b in parts)
        enough = n >= params.min_windows
        intercept, beta, rmse = solve(n, mean, products, params.ridge) if enough else (0.0, np.zeros(0), 0.0)
        out = table.slice(0, 1 if enough else 0).select([*keys, "sensor"] if wide else keys)
        for field, value in (
            ("windows", pa.array([n], pa.int64())), ("intercept", pa.array([intercept])),
            ("coefficients", pa.array([beta.tolist()], pa.list_(pa.float64()))), ("rmse", pa.array([rmse])),
        ):
            out = out.append_column(field, value.slice(0, out.num_rows))
        return out

    reduced = spread(blocks, [*keys, BLOCK]).groupBy(*keys, BLOCK).applyInArrow(
        reduce, f"{kinds}{label}, windows long, mean binary, products binary"
    )
    if wide and only is not None:
        reduced = reduced.join(only.select(*keys, "sensor").distinct(), [*keys, "sensor"], "left_semi")
    fields = f"{kinds}{label}, windows long, intercept double, coefficients array<double>, rmse double"
    return reduced.groupBy(*keys, *(["sensor"] if wide else [])).applyInArrow(fit, fields)


def series_forecast(
    df: DataFrame,
    spec: SeriesSpec,
    columns: Iterable[str],
    plan: DataFrame,
    models: SeriesModels,
    names: Iterable[str] | None = None,
) -> DataFrame:
    """``<column>_forecast`` for every position from ``start`` on: the reading before plus the change the model expects.

    A column without a model, or a row with a gap in its lags, has none.
    """
    columns = list(columns)
    wide, names = _sensor(spec, columns, list(names or columns))
    lookback, keys = models.lookback, list(spec.keys)
    rows = attach(df.select(*keys, POS, *columns), plan.select(*keys, "n", "start"), spec)
    rows = rows.filter(F.col(POS) >= F.col("start") - lookback)
    blocks = split_blocks(rows.drop("n"), spec, before=lookback)
    size = F.lit(0).cast("long") if spec.one_block else F.expr(f"(n - 1) div {spec.block_rows}")
    each = models.table.join(plan.select(*keys, "n"), keys).withColumn(BLOCK, F.explode(F.sequence(F.lit(0).cast("long"), size)))
    each = each.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(BLOCK).alias("_kb"), *(
        ["sensor"] if wide else []), "intercept", "coefficients")

    def predict(key: tuple, table: pa.Table, known: pa.Table) -> pa.Table:
        table = table.sort_by(POS)
        pos, own = table.column(POS).to_numpy(), table.column(OWN).to_numpy(zero_copy_only=False)
        out = table.select([*keys, POS])
        model = {
            r["sensor"] if wide else names[0]: (r["intercept"], np.array(r["coefficients"])) for r in known.to_pylist()
        }
        for c, name in zip(columns, names, strict=True):
            x, made = table.column(c).to_numpy().astype(float), np.full(len(pos), np.nan)
            if name in model and len(x):
                at, lags = windows(x, pos, lookback)
                made[at] = x[at - 1] + model[name][0] + lags @ model[name][1]
            out = out.append_column(f"{c}_forecast", pa.array(made, from_pandas=True))
        wanted = own & (pos >= table.column("start").to_numpy())
        return out.filter(pa.array(wanted))

    schema = f"{_keys(df, spec)}, {POS} long, " + ", ".join(f"`{c}_forecast` double" for c in columns)
    grouped = spread(blocks, [*keys, BLOCK]).groupBy(*keys, BLOCK)
    return grouped.cogroup(each.groupBy(*[f"_k{i}" for i in range(len(keys))], "_kb")).applyInArrow(predict, schema)
