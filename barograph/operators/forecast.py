"""Forecasts, their errors and their quality."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barograph.functions.columns import capped_season
from barograph.operators.lagmodel import LagModel, lag_forecast
from barograph.operators.sarima import rolling_sarima
from barograph.operators.seriesmodel import SeriesModels, series_forecast
from barograph.params import ForecastParams, SeriesSpec
from barograph.plans.layout import POS, Step, attach, block_window, fill_gaps, merge_blocks, run_chain, split_blocks

ERROR_COLUMNS = ("forecast_error", "forecast_error_mean", "forecast_error_std")


def forecast_plan(df: DataFrame, spec: SeriesSpec, params: ForecastParams = ForecastParams()) -> DataFrame:
    """Per series: rows ``n``, seasonal lag ``season`` and first forecast position ``start``.

    A series below the minimum length starts at its end, so it gets no forecast.
    """
    lookback = params.lookback + params.horizon
    n = F.col("n")
    if params.use_sarima:
        train = F.greatest(F.lit(lookback), 2 * F.col("season"))
    elif params.use_lag_model and not params.fast:
        train = F.lit(lookback)
    else:
        train = F.lit(max(params.min_rows, lookback))
    train = F.least(train, n - 1)
    tail = params.fast_tail_rows if params.fast else params.tail_rows
    start = F.greatest(train, n - tail) if tail > 0 else train
    return (
        df.groupBy(*spec.keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("season", capped_season(params.sarima.season, "n", params.sarima.min_seasons))
        .withColumn("start", F.when(n < params.min_rows, n).otherwise(start).cast("long"))
    )


def tail_mean(
    df: DataFrame,
    spec: SeriesSpec,
    columns: Iterable[str],
    names: Iterable[str] | None = None,
    rows: int = 3,
    history: int = 360,
    prefix: str = "forecast_",
) -> DataFrame:
    """Forecast each row by the mean of the last ``rows`` readings before it.

    Readings older than ``history`` rows do not count. The k-th last reading is
    carried along by k stacked running windows on one sort, so the work per row
    does not depend on ``history``.
    """
    columns = list(columns)
    names = list(names or columns)
    blocks = split_blocks(df, spec, before=history)
    earlier = block_window(spec).rowsBetween(Window.unboundedPreceding, -1)
    seen = {c: F.struct(F.col(c).cast("double").alias("v"), F.col(POS).alias("p")) for c in columns}
    for k in range(1, rows + 1):
        blocks = blocks.withColumns(
            {
                f"_{k}_{c}": F.last(F.when(F.col(c).isNotNull(), seen[c]), ignorenulls=True).over(earlier)
                for c in columns
            }
        )
        seen = {c: F.col(f"_{k}_{c}") for c in columns}
    out = {}
    for c, name in zip(columns, names):
        recent = [F.when(F.col(f"_{k}_{c}.p") >= F.col(POS) - history, F.col(f"_{k}_{c}.v")) for k in range(1, rows + 1)]
        # Added in the order of the rows, as a mean over a frame adds them: another order rounds differently.
        total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in reversed(recent)])
        found = sum((v.isNotNull().cast("int") for v in recent[1:]), recent[0].isNotNull().cast("int"))
        out[f"{prefix}{name}"] = F.when(found > 0, total / found)
    helpers = [f"_{k}_{c}" for k in range(1, rows + 1) for c in columns]
    return merge_blocks(blocks.withColumns(out), spec).drop(*helpers)


def ensemble(a: Column, b: Column, weights: tuple[float, float]) -> Column:
    """Weighted sum of two forecasts, or the one that exists."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(weights[0] * a + weights[1] * b)


def forecast_errors(df: DataFrame, spec: SeriesSpec, actual: str, forecast: str, window: int = 30) -> DataFrame:
    """Absolute error with its rolling mean and deviation, from one reading on."""
    blocks = split_blocks(df, spec, before=window - 1)
    blocks = blocks.withColumn("forecast_error", F.abs(F.col(actual) - F.col(forecast)))
    frame = block_window(spec).rowsBetween(-(window - 1), 0)
    return merge_blocks(
        blocks.withColumns(
            {
                "forecast_error_mean": F.avg("forecast_error").over(frame),
                "forecast_error_std": F.coalesce(F.stddev_samp("forecast_error").over(frame), F.lit(0.0)),
            }
        ),
        spec,
    )


def mask_warmup(df: DataFrame, rows: int, start: str = "start", columns: Iterable[str] = ERROR_COLUMNS) -> DataFrame:
    """Null the error columns on the first ``rows`` forecast rows of a series."""
    warming = (F.col(POS) >= F.col(start)) & (F.col(POS) < F.col(start) + rows)
    return df.withColumns({c: F.when(~warming, F.col(c)) for c in columns})


def forecast_metrics(df: DataFrame, keys: Iterable[str], actual: str, forecast: str) -> DataFrame:
    """RMSE, MAE and forecast variance over the rows where both values exist."""
    error = F.col(actual) - F.col(forecast)
    return (
        df.filter(F.col(actual).isNotNull() & F.col(forecast).isNotNull())
        .groupBy(*keys)
        .agg(
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(F.abs(error)).alias("mae"),
            F.var_samp(forecast).alias("forecast_variance"),
            F.count(F.lit(1)).alias("rows"),
        )
    )


def forecast_series(
    df: DataFrame,
    spec: SeriesSpec,
    columns: Iterable[str],
    names: Iterable[str] | None = None,
    params: ForecastParams = ForecastParams(),
    lag_model: LagModel | SeriesModels | None = None,
) -> DataFrame:
    """Add ``forecast_<name>`` for every column and the error of the primary one.

    Fast mode forecasts the last rows by the tail mean. Full mode blends the
    rolling seasonal model with the lag model; a forecaster that is off or has no
    value leaves the other one alone. With both off the frame is returned as is.
    """
    columns = list(columns)
    names = list(names or columns)
    if not params.use_sarima and not params.use_lag_model:
        return df
    primary = params.primary if params.primary in names else names[0]
    plan = forecast_plan(df, spec, params)
    planned = attach(df, plan.withColumnRenamed("start", "_start").drop("season"), spec)
    outputs = [f"forecast_{n}" for n in names]
    in_tail = F.col(POS) >= F.col("_start")
    actual = columns[names.index(primary)]
    errors = Step(
        lambda rows, inner: forecast_errors(rows, inner, actual, f"forecast_{primary}", params.error_window),
        params.error_window - 1,
    )
    if params.fast:
        # Forecasts and their errors are one chain: the rows are cut into blocks once.
        based = Step(
            lambda rows, inner: tail_mean(rows, inner, columns, names, params.baseline_rows, params.history_rows).withColumns(
                {o: F.when(in_tail, F.col(o)) for o in outputs}
            ),
            params.history_rows,
        )
        scored = run_chain(planned, spec, [based, errors])
    else:
        out = planned
        if params.use_sarima:
            seasonal = rolling_sarima(df, spec, columns, plan, params)
            seasonal = seasonal.select(*spec.keys, POS, *[F.col(f"{c}_forecast").alias(f"_s_{c}") for c in columns])
            out = out.join(seasonal, [*spec.keys, POS], "left")
        else:
            out = out.withColumns({f"_s_{c}": F.lit(None).cast("double") for c in columns})
        if params.use_lag_model:
            if isinstance(lag_model, SeriesModels):
                lagged = series_forecast(df, spec, columns, plan, lag_model, names)
            else:
                lagged = lag_forecast(df, spec, columns, plan, params, lag_model)
            lagged = lagged.select(*spec.keys, POS, *[F.col(f"{c}_forecast").alias(f"_l_{c}") for c in columns])
            out = out.join(lagged, [*spec.keys, POS], "left")
        else:
            out = out.withColumns({f"_l_{c}": F.lit(None).cast("double") for c in columns})
        blended = {}
        for c, name in zip(columns, names):
            weights = params.weight_primary if name == primary else params.weight_other
            blended[f"forecast_{name}"] = F.when(in_tail, ensemble(F.col(f"_s_{c}"), F.col(f"_l_{c}"), weights))
        out = out.withColumns(blended)
        if params.fill:
            out = fill_gaps(out, spec, outputs)
        scored = run_chain(out, spec, [errors])
    scored = mask_warmup(scored, params.warmup_rows, "_start")
    return scored.select(*df.columns, *outputs, *ERROR_COLUMNS)
