"""A whole station run: readings to results, quarantine and drift events."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.operators.anomaly import combine_flags, error_flag, zscore_flags
from barograph.operators.drift import drift_samples, ks_drift
from barograph.operators.features import complete_rows, composite_ratios, rolling_features
from barograph.operators.forecast import forecast_plan, forecast_series
from barograph.operators.forest import isolation_flags
from barograph.operators.lagmodel import LagModel, fit_lag_model
from barograph.operators.seasonal import seasonal_parts
from barograph.operators.seriesmodel import SeriesModelParams, SeriesModels, fit_series_models
from barograph.operators.smooth import kalman_smooth
from barograph.operators.validate import split_valid
from barograph.params import ForecastParams, RunParams, SeriesSpec
from barograph.plans.layout import POS, index_series
from barograph.session import materialize
from barograph.sources.models import ModelTable


@dataclass(frozen=True)
class StationRun:
    results: DataFrame
    rejected: DataFrame
    drift: DataFrame
    lag_model: LagModel | SeriesModels | None = None
    #: Models fitted by this run, for a table of models per series.
    fitted: DataFrame | None = None


def run_stations(
    readings: DataFrame,
    params: RunParams = RunParams(),
    lag_model: LagModel | None = None,
    models: ModelTable | None = None,
) -> StationRun:
    """Validate, smooth, build features, decompose, forecast, flag and test for drift.

    ``readings`` hold ``station``, ``timestamp`` and the sensors, one row per key.
    Stations are independent series. A ``lag_model`` of an earlier run saves the
    fit. With a table of ``models`` each station and sensor has a model of its own, and only those that the table
    lists as stale or drifted are fitted; the caller commits them. The frame is written down where several
    consumers follow: after the features, the decomposition and the forecasts.
    """
    sensors = list(params.sensors)
    smooth = [f"{s}_filt" for s in sensors]
    spec = SeriesSpec(("station",), ("timestamp",), params.block_rows)
    valid, rejected = split_valid(readings.select("station", "timestamp", *sensors), params.bounds, sensors)
    indexed, sized = index_series(valid, spec)
    smoothed = kalman_smooth(indexed, sized, sensors, params.kalman)
    features = composite_ratios(rolling_features(smoothed, sized, smooth, params.rolling_window, sensors))
    # Written before rows are dropped: a filter on features would compute them twice.
    kept = complete_rows(materialize(features, "features"), sized, params.rolling_window, params.drop)
    indexed, sized = index_series(kept.drop(POS), spec)
    parts = materialize(seasonal_parts(indexed, sized, smooth, params.seasonal, sensors), "parts")
    forecast = replace(params.forecast, primary=params.primary)
    fitted = None
    if models is not None and forecast.use_lag_model and not forecast.fast:
        lag_model, fitted = _series_models(parts, sized, smooth, sensors, forecast, models)
    elif lag_model is None and forecast.use_lag_model and not forecast.fast:
        lag_model = fit_lag_model(parts, sized, smooth, forecast_plan(parts, sized, forecast), forecast)
        forecast = replace(forecast, use_lag_model=lag_model is not None)
    predicted = materialize(forecast_series(parts, sized, smooth, sensors, forecast, lag_model), "forecasts")
    flags = params.anomaly
    flagged = isolation_flags(predicted, sized, smooth, flags.forest)
    by_score = {"anomaly_zscore": smooth, "anomaly_residual": [f"{params.primary}_residual"]}
    flagged = zscore_flags(flagged, sized, by_score, flags.z_threshold)
    scored = "forecast_error" in flagged.columns
    error = error_flag(flags.error_mode, flags.error_threshold, flags.error_k) if scored else None
    flagged = flagged.withColumn("anomaly_forecast_error", error) if scored else flagged.selectExpr(
        "*", "0 AS anomaly_forecast_error"
    )
    results = combine_flags(flagged).drop(POS)
    drift = ks_drift(drift_samples(predicted, sized, smooth, params.drift), ("station", "sensor"), params.drift)
    return StationRun(results, rejected, drift, lag_model, fitted)


def _series_models(
    parts: DataFrame, spec: SeriesSpec, columns: list[str], sensors: list[str], forecast: ForecastParams, models: ModelTable
) -> tuple[SeriesModels, DataFrame]:
    """The models to forecast with, and those of them that were fitted now."""
    spark = parts.sparkSession
    series = parts.select("station").distinct().withColumn("sensor", F.explode(F.array(*map(F.lit, sensors))))
    listed = materialize(models.to_refit(spark, series), "refit")
    chosen = SeriesModelParams(forecast.lookback)
    plan = forecast_plan(parts, spec, forecast)
    fitted = materialize(fit_series_models(parts, spec, columns, plan, chosen, sensors, listed), "fitted")
    return SeriesModels(materialize(models.valid(spark, listed, fitted), "models"), forecast.lookback), fitted
