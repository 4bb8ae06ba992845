"""Rolling-origin seasonal forecasts over many series."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.functions import sarima
from barograph.params import ForecastParams, SarimaParams, SeriesSpec
from barograph.plans.layout import POS, attach, spread

_SPAN = "_span"
#: Origins that a group forecasts; their models are fitted side by side.
_ORIGINS = 32


def _key_schema(df: DataFrame, spec: SeriesSpec) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in spec.keys)


def rolling_sarima(
    df: DataFrame, spec: SeriesSpec, columns: Iterable[str], plan: DataFrame, params: ForecastParams = ForecastParams()
) -> DataFrame:
    """One-step forecasts with 95 % limits for every position from ``start`` on.

    The model is fitted anew every ``refit_rows`` positions on the rows before
    that origin only. Origins do not depend on each other: a series is cut into spans
    of ``_ORIGINS`` of them, and each row is copied to the spans whose history it belongs to. A
    (series, span) group holds at most ``history_rows + _ORIGINS * refit_rows`` rows, so one very long series is
    forecast by as many tasks as there are spans, and copying adds a part of the input only.
    """
    columns = list(columns)
    history, refit = params.history_rows, params.refit_rows
    span = _ORIGINS * refit
    rows = attach(df.select(*spec.keys, POS, *columns), plan, spec).filter(
        (F.col("start") < F.col("n")) & (F.col(POS) >= F.col("start") - history)
    )
    first = F.expr(f"greatest(({POS} - start) div {span}, 0)")
    last = F.expr(f"least(({POS} + {history} - start) div {span}, (n - 1 - start) div {span})")
    copies = rows.withColumn(_SPAN, F.explode(F.sequence(first, last)))
    parts = ("forecast", "lower", "upper")
    schema = f"{_key_schema(df, spec)}, {POS} long, " + ", ".join(f"`{c}_{p}` double" for c in columns for p in parts)

    def forecast(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(POS)
        pos, season = pdf[POS].to_numpy(), int(pdf["season"].iloc[0])
        begin = int(pdf["start"].iloc[0]) + span * int(pdf[_SPAN].iloc[0])
        origins = range(begin, int(pos[-1]) + 1, refit)
        edges = np.searchsorted(pos, [(o - history, o, o + refit) for o in origins])
        out = pdf.loc[pos >= begin, [*spec.keys, POS]].copy()
        for c in columns:
            x = pdf[c].to_numpy(float)
            past, ahead = [x[a:b] for a, b, _ in edges], [x[b:e] for _, b, e in edges]
            models = sarima.fit_many(past, params.sarima, season)
            values, reach = [np.full(len(a), np.nan) for a in ahead], [np.full(len(a), np.nan) for a in ahead]
            fitted = [i for i, m in enumerate(models) if m]
            if fitted:
                made = sarima.one_step_forecasts(*([of[i] for i in fitted] for of in (models, past, ahead)))
                for i, v in zip(fitted, made, strict=True):
                    values[i], reach[i] = v, np.full(len(v), sarima.Z_95 * models[i].sigma)
            values, reach = np.concatenate(values), np.concatenate(reach)
            out[f"{c}_forecast"], out[f"{c}_lower"], out[f"{c}_upper"] = values, values - reach, values + reach
        return out

    return spread(copies, [*spec.keys, _SPAN]).groupBy(*spec.keys, _SPAN).applyInPandas(forecast, schema)


def fit_sarima(
    df: DataFrame,
    spec: SeriesSpec,
    column: str,
    plan: DataFrame,
    params: SarimaParams = SarimaParams(),
    train_rows: int = 1500,
) -> DataFrame:
    """Model table: one row per series, fitted on its last ``train_rows`` rows."""
    tail = attach(df.select(*spec.keys, POS, column), plan.select(*spec.keys, "n", "season"), spec).filter(
        F.col(POS) >= F.col("n") - train_rows
    )
    schema = f"{_key_schema(df, spec)}, season long, theta array<double>, sigma double, trained_rows long"

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(POS)[column].to_numpy(float)
        row = pdf[[*spec.keys, "season"]].iloc[:1].copy()
        model = sarima.fit(x, params, int(row["season"].iloc[0]))
        row["theta"] = [model.theta.tolist() if model else None]
        row["sigma"] = model.sigma if model else np.nan
        row["trained_rows"] = int((~np.isnan(x)).sum())
        return row

    return spread(tail, spec.keys).groupBy(*spec.keys).applyInPandas(fit, schema)


def refresh_models(
    models: DataFrame,
    to_refit: DataFrame,
    df: DataFrame,
    spec: SeriesSpec,
    column: str,
    plan: DataFrame,
    params: SarimaParams = SarimaParams(),
    train_rows: int = 1500,
) -> DataFrame:
    """Model table with the listed series fitted anew; the others are taken over as they are."""
    keys = list(spec.keys)
    chosen = df.join(to_refit.select(*keys).distinct(), keys, "left_semi")
    fresh = fit_sarima(chosen, spec, column, plan, params, train_rows)
    return models.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def forecast_ahead(
    df: DataFrame,
    spec: SeriesSpec,
    column: str,
    plan: DataFrame,
    params: ForecastParams = ForecastParams(),
    steps: int = 6,
) -> DataFrame:
    """The next ``steps`` values after the end of each series, with 95 % limits."""
    tail = attach(df.select(*spec.keys, POS, column), plan.select(*spec.keys, "n", "season"), spec).filter(
        F.col(POS) >= F.col("n") - params.history_rows
    )
    schema = f"{_key_schema(df, spec)}, step long, forecast double, lower double, upper double"

    def ahead(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(POS)[column].to_numpy(float)
        x = x[~np.isnan(x)]
        model = sarima.fit(x, params.sarima, int(pdf["season"].iloc[0]))
        if model is None:
            return pd.DataFrame(columns=[*spec.keys, "step", "forecast", "lower", "upper"])
        values = sarima.next_values(model, x, sarima.observed_innovations(model, x), steps)
        reach = sarima.Z_95 * sarima.spread_of(model, steps)
        out = pd.DataFrame({"step": np.arange(1, steps + 1), "forecast": values})
        out["lower"], out["upper"] = values - reach, values + reach
        for k in spec.keys:
            out[k] = pdf[k].iloc[0]
        return out[[*spec.keys, "step", "forecast", "lower", "upper"]]

    return spread(tail, spec.keys).groupBy(*spec.keys).applyInPandas(ahead, schema)
