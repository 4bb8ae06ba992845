"""Queries on models: statistics, forecasts, flags, drift, alerts, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.catalog.inputs import (
    HOURLY,
    HOURLY_SENSORS,
    INDEXED_SQL,
    LONG,
    READINGS_SQL,
    hourly,
    hourly_sql,
    indexed,
    indexed_hourly,
    readings,
    rounded,
    rounded_sql,
)
from barograph.catalog.registry import SMALL, laid_out, query
from barograph.catalog.windows import K, KEYS, seasonal_sql
from barograph.functions.columns import flag
from barograph.operators.anomaly import (
    anomalous,
    combine_flags,
    detector_counts as count_detectors,
    error_flag,
    mean_impute as impute,
    outlier_label,
    series_stats as stats_of,
    zscore_flags as flag_zscores,
)
from barograph.operators.drift import (
    asymptotic_p,
    drift_flags,
    drift_samples as take_samples,
    ks_drift,
    ks_statistic as ks,
    retrain_list as to_retrain,
)
from barograph.operators.features import rolling_features
from barograph.operators.forecast import (
    ensemble,
    forecast_errors,
    forecast_metrics as metrics_of,
    forecast_plan,
    forecast_series,
    mask_warmup,
    tail_mean,
)
from barograph.operators.forest import isolation_flags, tree_samples
from barograph.operators.lagmodel import lag_windows as windows_of, rolling_lag_forecast
from barograph.operators.report import (
    alert_sample as sample_of,
    alert_summary as summary_of,
    markdown_report as report_of,
    run_metrics as metrics_row,
)
from barograph.operators.sarima import fit_sarima, forecast_ahead, rolling_sarima
from barograph.operators.scaling import minmax_scale as scale
from barograph.operators.seasonal import seasonal_parts
from barograph.operators.seriesmodel import SeriesModelParams, fit_series_models
from barograph.operators.validate import split_valid
from barograph.params import ForecastParams, RunParams, SeasonalParams, SeriesSpec
from barograph.plans.layout import POS, attach, index_series
from barograph.plans.run import run_stations
from barograph.session import materialize, work_path
from barograph.sources.models import ModelTable

SERIES = ("station", "sensor")
DAY = SeasonalParams(period=24)


# Statistics over whole series.


@query(
    f"""WITH {READINGS_SQL} SELECT station, sensor, count(*) AS n, {rounded_sql('avg(value)', 'value_mean', 6)},
 {rounded_sql('stddev_samp(value)', 'value_std')} FROM r GROUP BY ALL"""
)
def series_stats(spark, sf_dir):
    made = stats_of(readings(spark, sf_dir), LONG, ["value"])
    return rounded(rounded(made, ["value_mean"], 6), ["value_std"])


@query(
    f"""WITH {hourly_sql(True)} SELECT station, "timestamp", {", ".join(
        rounded_sql(f'coalesce({s}, avg({s}) OVER (PARTITION BY station))', s) for s in HOURLY_SENSORS)} FROM h""",
    SMALL,
)
def mean_impute(spark, sf_dir):
    df, spec = indexed_hourly(spark, sf_dir)
    return rounded(impute(df, spec, HOURLY_SENSORS).drop(POS), HOURLY_SENSORS)


@query(
    f"""WITH {READINGS_SQL}, l AS (SELECT *, min(value) OVER s AS low, max(value) OVER s AS high FROM r
 WINDOW s AS (PARTITION BY station, sensor))
SELECT {K}, {rounded_sql('(value - low) / CASE WHEN high = low THEN 1e-6 ELSE high - low END', 'value_scaled', 6)} FROM l""",
    SMALL,
)
def minmax_scale(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    return rounded(scale(df, spec, ["value"]).select(*KEYS, "value_scaled"), ["value_scaled"], 6)


# Flags.

_Z = "PARTITION BY station, sensor"
ZSCORE_SQL = f"""{INDEXED_SQL},
z AS (SELECT *, CAST(coalesce(stddev_samp(value) OVER w > 0
  AND abs((value - avg(value) OVER w) / stddev_samp(value) OVER w) > 2.0, false) AS INTEGER) AS anomaly_zscore
  FROM p WINDOW w AS ({_Z}))"""


@query(f"WITH {ZSCORE_SQL} SELECT {K}, anomaly_zscore FROM z", SMALL)
def zscore_flags(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    return flag_zscores(df, spec, {"anomaly_zscore": ["value"]}, 2.0).select(*KEYS, "anomaly_zscore")


_TAIL = "avg(value) OVER (PARTITION BY station, sensor ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"
_START = "CASE WHEN n < 30 THEN n ELSE greatest(least(54, n - 1), n - 120) END"
FORECAST_SQL = f"{INDEXED_SQL}, f AS (SELECT *, {_TAIL} AS forecast FROM p)"


@query(f"WITH {FORECAST_SQL} SELECT {K}, {rounded_sql('forecast', 'forecast', 6)} FROM f", SMALL)
def tail_mean_forecast(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    made = tail_mean(df, spec, ["value"], ["value"]).withColumnRenamed("forecast_value", "forecast")
    return rounded(made.select(*KEYS, "forecast"), ["forecast"], 6)


@query(
    f"""WITH {INDEXED_SQL}, c AS (SELECT DISTINCT station, sensor, n FROM p),
s AS (SELECT *, CAST(CASE WHEN n < 44 THEN 2 ELSE least(60, greatest(2, n // 24)) END AS BIGINT) AS season FROM c)
SELECT station, sensor, n, season, CAST(CASE WHEN n < 30 THEN n ELSE greatest(least(greatest(54, 2 * season), n - 1), n - 600) END AS BIGINT) AS start FROM s"""
)
def forecast_origins(spark, sf_dir):
    return forecast_plan(readings(spark, sf_dir), LONG)


_E = "(PARTITION BY station, sensor ORDER BY pos ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
ERROR_SQL = f"""{FORECAST_SQL},
e0 AS (SELECT *, abs(value - forecast) AS forecast_error FROM f),
e AS (SELECT *, avg(forecast_error) OVER {_E} AS forecast_error_mean,
  coalesce(stddev_samp(forecast_error) OVER {_E}, 0.0) AS forecast_error_std FROM e0)"""
ERRORS = ("forecast_error", "forecast_error_mean", "forecast_error_std")
ERRORS_SQL = ", ".join(rounded_sql(c, c, 7) for c in ERRORS)


def _with_errors(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    made = tail_mean(df, spec, ["value"], ["value"]).withColumnRenamed("forecast_value", "forecast")
    return forecast_errors(made, spec, "value", "forecast", 30)


@query(f"WITH {ERROR_SQL} SELECT {K}, {ERRORS_SQL} FROM e", SMALL)
def forecast_error_stats(spark, sf_dir):
    return rounded(_with_errors(*indexed(spark, sf_dir)).select(*KEYS, *ERRORS), ERRORS, 7)


_MASKED = ", ".join(
    rounded_sql(f"CASE WHEN NOT (pos >= ({_START}) AND pos < ({_START}) + 48) THEN {c} END", c, 7) for c in ERRORS
)


@query(f"WITH {ERROR_SQL} SELECT {K}, {_MASKED} FROM e", SMALL)
def warmup_mask(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    plan = forecast_plan(df, spec, ForecastParams(use_sarima=False, fast=True))
    planned = attach(_with_errors(df, spec), plan, spec)
    return rounded(mask_warmup(planned, 48).select(*KEYS, *ERRORS), ERRORS, 7)


@query(
    f"""WITH {INDEXED_SQL}, f AS (SELECT *, CASE WHEN pos >= ({_START}) THEN {_TAIL} END AS forecast FROM p),
e0 AS (SELECT *, abs(value - forecast) AS forecast_error FROM f),
e AS (SELECT *, avg(forecast_error) OVER {_E} AS forecast_error_mean, coalesce(stddev_samp(forecast_error) OVER {_E}, 0.0) AS forecast_error_std FROM e0)
SELECT {K}, {rounded_sql('forecast', 'forecast_value', 7)}, {_MASKED} FROM e""",
    SMALL,
)
def fast_forecast(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    params = ForecastParams(use_sarima=False, fast=True, primary="value")
    made = forecast_series(df, spec, ["value"], params=params).select(*KEYS, "forecast_value", *ERRORS)
    return rounded(made, ["forecast_value", *ERRORS], 7)


@query(
    f"""WITH {FORECAST_SQL} SELECT station, sensor, {rounded_sql('sqrt(avg((value - forecast) * (value - forecast)))', 'rmse')},
 {rounded_sql('avg(abs(value - forecast))', 'mae')}, {rounded_sql('var_samp(forecast)', 'forecast_variance')},
 count(*) AS rows FROM f WHERE value IS NOT NULL AND forecast IS NOT NULL GROUP BY ALL"""
)
def forecast_metrics(spark, sf_dir):
    made = metrics_of(_with_errors(*indexed(spark, sf_dir)), SERIES, "value", "forecast")
    return rounded(made, ["rmse", "mae", "forecast_variance"])


@query(
    f"""WITH {FORECAST_SQL}, l AS (SELECT *, CASE WHEN pos % 5 <> 0 THEN lag(value) OVER (PARTITION BY station, sensor ORDER BY pos) END AS last FROM f),
w AS (SELECT *, CASE WHEN sensor = 'view' THEN 0.45 * forecast + 0.55 * last ELSE 0.15 * forecast + 0.85 * last END AS mixed FROM l)
SELECT {K}, {rounded_sql('CASE WHEN forecast IS NULL THEN last WHEN last IS NULL THEN forecast ELSE mixed END', 'blend', 7)} FROM w"""
)
def ensemble_forecast(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    made = tail_mean(df, spec, ["value"], ["a"])
    made = tail_mean(made, spec, ["value"], ["b"], rows=1, history=1)
    last = F.when(F.col(POS) % 5 != 0, F.col("forecast_b"))
    params = ForecastParams()
    primary = ensemble(F.col("forecast_a"), last, params.weight_primary)
    other = ensemble(F.col("forecast_a"), last, params.weight_other)
    blend = F.when(F.col("sensor") == "view", primary).otherwise(other).alias("blend")
    return rounded(made.select(*KEYS, blend), ["blend"], 7)


@query(f"WITH {ERROR_SQL} SELECT {K}, CAST(coalesce(forecast_error > 80.5, false) AS INTEGER) AS anomaly_forecast_error FROM e")
def forecast_error_fixed(spark, sf_dir):
    made = _with_errors(*indexed(spark, sf_dir))
    return made.select(*KEYS, error_flag("fixed", 80.5).alias("anomaly_forecast_error"))


ADAPTIVE_SQL = """CAST(coalesce(forecast_error > forecast_error_mean + 3.0 * forecast_error_std, false) AS INTEGER)"""


@query(f"WITH {ERROR_SQL} SELECT {K}, {ADAPTIVE_SQL} AS anomaly_forecast_error FROM e")
def forecast_error_adaptive(spark, sf_dir):
    made = _with_errors(*indexed(spark, sf_dir))
    return made.select(*KEYS, error_flag("adaptive", k=3.0).alias("anomaly_forecast_error"))


RESIDUAL_SQL = f"""{seasonal_sql(24)},
rf AS (SELECT station, sensor, seq, CAST(coalesce(stddev_samp(residual) OVER w > 0
  AND abs((residual - avg(residual) OVER w) / stddev_samp(residual) OVER w) > 2.0, false) AS INTEGER) AS anomaly_residual
  FROM s5 WINDOW w AS ({_Z}))"""


@query(f"WITH {RESIDUAL_SQL} SELECT {K}, anomaly_residual FROM rf", SMALL)
def residual_flags(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    parts = materialize(seasonal_parts(df, spec, ["value"], DAY), "parts")
    return flag_zscores(parts, spec, {"anomaly_residual": ["value_residual"]}, 2.0).select(*KEYS, "anomaly_residual")


FLAGS = ("anomaly_zscore", "anomaly_residual", "anomaly_forecast_error")
FLAGGED_SQL = f"""{RESIDUAL_SQL},
z AS (SELECT *, CAST(coalesce(abs((value - avg(value) OVER w) / stddev_samp(value) OVER w) > 2.0, false) AS INTEGER) AS anomaly_zscore
  FROM p WINDOW w AS ({_Z})),
e0 AS (SELECT *, abs(value - {_TAIL}) AS forecast_error FROM z),
e AS (SELECT *, avg(forecast_error) OVER {_E} AS forecast_error_mean,
  coalesce(stddev_samp(forecast_error) OVER {_E}, 0.0) AS forecast_error_std FROM e0),
g AS (SELECT e.*, rf.anomaly_residual, {ADAPTIVE_SQL} AS anomaly_forecast_error FROM e JOIN rf USING (station, sensor, seq)),
a AS (SELECT *, greatest(anomaly_zscore, anomaly_residual, anomaly_forecast_error) AS anomaly_combined FROM g)"""


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, spec = indexed(spark, sf_dir)
    parts = materialize(_with_errors(seasonal_parts(df, spec, ["value"], DAY), spec), "parts")
    flagged = flag_zscores(parts, spec, {"anomaly_zscore": ["value"], "anomaly_residual": ["value_residual"]}, 2.0)
    return combine_flags(flagged.withColumn("anomaly_forecast_error", error_flag()), FLAGS)


@query(f"WITH {FLAGGED_SQL} SELECT {K}, {', '.join(FLAGS)}, anomaly_combined FROM a", SMALL)
def anomaly_combined(spark, sf_dir):
    return _flagged(spark, sf_dir).select(*KEYS, *FLAGS, "anomaly_combined")


@query(
    f"""WITH {FLAGGED_SQL} SELECT {K}, CASE WHEN anomaly_combined = 1 THEN -1 ELSE 1 END AS anomaly,
 CASE WHEN anomaly_combined = 1 THEN 'Outlier' ELSE 'Normal' END AS label FROM a"""
)
def anomaly_labels(spark, sf_dir):
    return _flagged(spark, sf_dir).select(*KEYS, "anomaly", outlier_label().alias("label"))


@query(f"WITH {FLAGGED_SQL} SELECT {K}, ts, value FROM a WHERE anomaly_combined = 1")
def anomaly_rows(spark, sf_dir):
    return anomalous(_flagged(spark, sf_dir)).select(*KEYS, "ts", "value")


@query(
    f"""WITH {FLAGGED_SQL} SELECT station, count(*) AS rows, {', '.join(f'CAST(sum({f}) AS BIGINT) AS {f}' for f in FLAGS)},
 CAST(sum(anomaly_combined) AS BIGINT) AS anomaly_combined FROM a GROUP BY station"""
)
def detector_counts(spark, sf_dir):
    return count_detectors(_flagged(spark, sf_dir), ["station"], FLAGS)


@query(
    f"""WITH {FLAGGED_SQL} SELECT station, count(*) AS total_records, CAST(sum(anomaly_combined) AS BIGINT) AS anomaly_count,
 round(100.0 * sum(anomaly_combined) / count(*), 2) AS anomaly_pct FROM a GROUP BY station HAVING sum(anomaly_combined) >= 1"""
)
def alert_summary(spark, sf_dir):
    return summary_of(_flagged(spark, sf_dir), ["station"])


@query(
    f"""WITH {FLAGGED_SQL}, s AS (SELECT station, sensor, ts, value,
 CAST(row_number() OVER (PARTITION BY station ORDER BY ts, seq) AS INTEGER) AS row FROM a WHERE anomaly_combined = 1)
SELECT * FROM s WHERE row <= 5"""
)
def alert_sample(spark, sf_dir):
    found = sample_of(_flagged(spark, sf_dir), ["station"], ["ts", "seq"])
    return found.select("station", "sensor", "ts", "value", "row")


@query(f"WITH {FLAGGED_SQL} SELECT count(*) AS records_total, CAST(sum(anomaly_combined) AS BIGINT) AS anomalies FROM a")
def run_metrics(spark, sf_dir):
    return metrics_row(_flagged(spark, sf_dir))


@query(
    f"""WITH {READINGS_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY ts, seq) AS rn,
 count(*) OVER (PARTITION BY station) AS total FROM r),
l AS (SELECT station, rn, total, '| ' || sensor || ' | ' || CAST(seq AS VARCHAR) || ' | ' || CAST(value AS VARCHAR) || ' |' AS line
 FROM k WHERE rn <= 200)
SELECT station, '# Predicted Atmospheric Data' || chr(10) || chr(10) || '- Total CSV rows: ' || any_value(total) || chr(10)
 || '- Rows included in this upload: ' || count(*) || chr(10) || chr(10) || '| sensor | seq | value |' || chr(10)
 || '| --- | --- | --- |' || chr(10) || string_agg(line, chr(10) ORDER BY rn) || chr(10) AS document FROM l GROUP BY station"""
)
def markdown_report(spark, sf_dir):
    return report_of(readings(spark, sf_dir), ["station"], ["sensor", "seq", "value"], ["ts", "seq"])


@query(f"WITH {INDEXED_SQL} SELECT {K}, pos, value FROM p WHERE pos >= n - 120", SMALL)
def tail_rows(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    sizes = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n"))
    return attach(df, sizes, spec).filter(F.col(POS) >= F.col("n") - 120).select(*KEYS, POS, "value")


@query(
    f"""WITH {INDEXED_SQL}, l AS (SELECT *, list(value) OVER (PARTITION BY station, sensor ORDER BY pos ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS lags,
 list(value) OVER (PARTITION BY station, sensor ORDER BY pos ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS targets FROM p)
SELECT {K}, array_to_string(lags, ',') AS lags, array_to_string(targets, ',') AS targets FROM l WHERE len(lags) = 6 AND len(targets) = 2""",
    SMALL,
)
def lag_windows(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    made = windows_of(df, spec, ["value"], 6, 2)
    texts = [F.array_join(F.transform(c, lambda v: v.cast("string")), ",").alias(c) for c in ("lags", "targets")]
    return made.select(*KEYS, *texts)


# Drift.

SAMPLES_SQL = f"""{INDEXED_SQL},
d0 AS (SELECT *, least(120, n // 2) AS b, least(60, n - least(120, n // 2)) AS c FROM p WHERE n >= 50),
d AS (SELECT station, sensor, 'baseline' AS sample, pos, value FROM d0 WHERE pos < b AND b >= 10 AND c >= 10
 UNION ALL SELECT station, sensor, 'comparison', pos, value FROM d0 WHERE pos >= n - c AND b >= 10 AND c >= 10)"""
KS_SQL = f"""{SAMPLES_SQL},
v AS (SELECT station, sensor, value, count(*) FILTER (WHERE sample = 'baseline') AS a, count(*) FILTER (WHERE sample = 'comparison') AS b
  FROM d GROUP BY ALL),
u AS (SELECT station, sensor, sum(a) OVER o AS ca, sum(b) OVER o AS cb, sum(a) OVER s AS n1, sum(b) OVER s AS n2 FROM v
  WINDOW o AS (PARTITION BY station, sensor ORDER BY value), s AS (PARTITION BY station, sensor)),
ks AS (SELECT station, sensor, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, CAST(max(abs(ca * n2 - cb * n1)) AS BIGINT) AS h
  FROM u GROUP BY ALL)"""
EXACT_SQL = f"""{KS_SQL},
walk AS (SELECT station, sensor, n1 AS m, n2 AS n, h, CAST(0 AS BIGINT) AS s, i.range AS i,
   CASE WHEN i.range = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS mass, 0.0::DOUBLE AS hit FROM ks, range(0, 121) i WHERE i.range <= n1
 UNION ALL
 SELECT station, sensor, m, n, h, s + 1, i, CASE WHEN abs(i * n - (s + 1 - i) * m) >= h THEN 0.0 ELSE moved END,
   CASE WHEN abs(i * n - (s + 1 - i) * m) >= h THEN moved ELSE 0.0 END
 FROM (SELECT *, mass * greatest(n - (s - i), 0) / (m + n - s)
    + coalesce(lag(mass * (m - i) / (m + n - s)) OVER (PARTITION BY station, sensor ORDER BY i), 0.0) AS moved
   FROM walk WHERE s < m + n)),
pv AS (SELECT station, sensor, n1, n2, h, CASE WHEN min(h) = 0 THEN 1.0 ELSE least(sum(hit), 1.0) END AS p_value
  FROM walk JOIN ks USING (station, sensor, h) GROUP BY ALL)"""


def _samples(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    return take_samples(df, spec, ["value"])


@query(f"WITH {SAMPLES_SQL} SELECT station, sensor, sample, pos, value FROM d", SMALL)
def drift_samples(spark, sf_dir):
    return _samples(spark, sf_dir)


@query(f"WITH {KS_SQL} SELECT station, sensor, n1, n2, {rounded_sql('h / (n1 * n2)', 'd', 6)} FROM ks")
def ks_statistic(spark, sf_dir):
    return rounded(ks(_samples(spark, sf_dir), SERIES).drop("h"), ["d"], 6)


@query(
    f"""WITH {KS_SQL}, x AS (SELECT *, (h / (n1 * n2)) * (h / (n1 * n2)) * n1 * n2 / (n1 + n2) AS x FROM ks)
SELECT station, sensor, {rounded_sql('''CASE WHEN any_value(h) = 0 THEN 1.0 ELSE greatest(0.0, least(1.0,
 2 * sum((CASE WHEN k.range % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k.range * k.range * x)))) END''', 'p_value', 6)}
FROM x, range(1, 101) k GROUP BY station, sensor"""
)
def ks_pvalue_asymptotic(spark, sf_dir):
    tested = ks(_samples(spark, sf_dir), SERIES)
    return rounded(tested.select(*SERIES, asymptotic_p().alias("p_value")), ["p_value"], 6)


@query(f"WITH RECURSIVE {EXACT_SQL} SELECT station, sensor, {rounded_sql('p_value', 'p_value', 6)}, CAST(p_value < 0.05 AS INTEGER) AS drift FROM pv")
def ks_pvalue_exact(spark, sf_dir):
    tested = ks_drift(_samples(spark, sf_dir), SERIES)
    return rounded(tested.select(*SERIES, "p_value", "drift"), ["p_value"], 6)


@query(f"WITH RECURSIVE {EXACT_SQL} SELECT station, CAST(max(CAST(p_value < 0.05 AS INTEGER)) AS INTEGER) AS drift FROM pv GROUP BY station")
def drift_flag(spark, sf_dir):
    return drift_flags(ks_drift(_samples(spark, sf_dir), SERIES), ["station"])


@query(f"WITH RECURSIVE {EXACT_SQL} SELECT station, sensor FROM pv WHERE p_value < 0.5 AND sensor <> 'view'")
def retrain_list(spark, sf_dir):
    tested = ks_drift(_samples(spark, sf_dir), SERIES)
    events = tested.withColumn("drift", flag(F.col("p_value") < 0.5))
    consumed = readings(spark, sf_dir).filter("sensor = 'view'").select(*SERIES).distinct()
    return to_retrain(events, consumed, SERIES)


# Models per series: run 1 fits the first half of every series but "error"; run 2 fits those without a
# model, too short in run 1 or new, and the drifted ones on all rows.

REFIT_SQL = f"""{EXACT_SQL},
w0 AS (SELECT station, sensor, pos, n, lag(value) OVER (PARTITION BY station, sensor ORDER BY pos) AS x, value FROM p),
w AS (SELECT station, sensor, pos, n, x, value - x AS y FROM w0 WHERE x IS NOT NULL AND value IS NOT NULL),
again AS (SELECT DISTINCT station, sensor FROM p WHERE sensor = 'error' UNION SELECT station, sensor FROM pv WHERE p_value < 0.5
 UNION SELECT station, sensor FROM w0 GROUP BY station, sensor
  HAVING count(*) FILTER (WHERE x IS NOT NULL AND value IS NOT NULL AND pos < n // 2) < 10),
f1 AS (SELECT w.station, w.sensor, 1 AS run, x, y FROM w ANTI JOIN again USING (station, sensor) WHERE pos < n // 2),
f2 AS (SELECT w.station, w.sensor, 2 AS run, x, y FROM w SEMI JOIN again USING (station, sensor)),
g AS (SELECT station, sensor, run, count(*) AS windows, avg(x) AS mx, avg(y) AS my, covar_pop(y, x) / (var_pop(x) * 1.1) AS slope
  FROM (SELECT * FROM f1 UNION ALL SELECT * FROM f2) GROUP BY ALL HAVING count(*) >= 10)
SELECT CAST(station AS VARCHAR) AS station, sensor, CAST(run AS BIGINT) AS run, windows,
  {rounded_sql('my - slope * mx', 'intercept')}, {rounded_sql('slope', 'slope')} FROM g"""


@query(f"WITH RECURSIVE {REFIT_SQL}")
def models_after_drift(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    table = ModelTable(work_path(spark, "models"), ("value",), "value", 1)
    plan, params = df.groupBy(*SERIES).agg(F.count("*").alias("n")), SeriesModelParams(lookback=1, ridge=0.1)
    halves = plan.filter("sensor <> 'error'").withColumn("start", F.expr("n div 2"))
    table.commit(_by_text(fit_series_models(df, spec, ["value"], halves, params)), 1)
    tested = ks_drift(_samples(spark, sf_dir), SERIES)
    table.add_events(tested.withColumn("drift", flag(F.col("p_value") < 0.5)), 1)
    listed = materialize(table.to_refit(spark, plan), "refit").withColumn("station", F.col("station").cast("long"))
    whole = plan.withColumn("start", F.col("n"))
    table.commit(_by_text(fit_series_models(df, spec, ["value"], whole, params, only=listed)), 2)
    current = table.current(spark).withColumn("slope", F.col("coefficients")[0])
    return rounded(current.select(*SERIES, "run", "windows", "intercept", "slope"), ["intercept", "slope"])


def _by_text(models):
    return models.withColumn("station", F.col("station").cast("string"))


# Fitted models: no SQL states them; tests hold them against brute force and planted signals.


@query()
def rolling_origin(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    params = ForecastParams(tail_rows=0)
    made = rolling_sarima(df, spec, ["value"], forecast_plan(df, spec, params), params)
    return made.withColumnsRenamed({f"value_{p}": p for p in ("forecast", "lower", "upper")})


@query()
def sarima_models(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    return fit_sarima(df, spec, "value", forecast_plan(df, spec))


@query()
def forecast_interval(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    return forecast_ahead(df, spec, "value", forecast_plan(df, spec))


@query()
def lag_model(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    params = ForecastParams(use_sarima=False, lookback=24, tail_rows=0)
    return rolling_lag_forecast(df, spec, ["value"], forecast_plan(df, spec, params), params)


_H1 = "(pos % 2147483647 * 48271 + t.range * 69621 + 42) % 2147483647"
_H2 = "(h1 * h1 + tree * 16807 + pos) % 2147483647"


@query(
    f"""WITH {READINGS_SQL}, q AS (SELECT station, row_number() OVER (PARTITION BY station ORDER BY ts, seq) - 1 AS pos FROM r),
a AS (SELECT station, pos, t.range AS tree, {_H1} AS h1 FROM q, range(0, 100) t),
b AS (SELECT *, {_H2} AS h2 FROM a),
c AS (SELECT station, tree, pos, row_number() OVER (PARTITION BY station, tree ORDER BY (h2 * h2 + h1) % 2147483647, pos) AS place FROM b)
SELECT station, tree, pos, CAST(place AS INTEGER) AS place FROM c WHERE place <= 256""",
    SMALL,
)
def forest_samples(spark, sf_dir):
    """The rows that each tree of a station's forest is built on: the smallest hashes of the whole series."""
    df, spec = index_series(readings(spark, sf_dir), laid_out(SeriesSpec(("station",), ("ts", "seq"))))
    sized = attach(df.select("station", POS), df.groupBy("station").agg(F.count("*").alias("n")), spec)
    return tree_samples(sized, spec).select("station", "tree", POS, "place")


@query()
def isolation_forest(spark, sf_dir):
    """One forest per station on the reading, its step and its hour."""
    spec = SeriesSpec(("station",), ("ts", "seq"))
    df, spec = index_series(readings(spark, sf_dir).withColumn("hour", F.hour("ts").cast("double")), spec)
    stepped = rolling_features(df, spec, ["value"], 6, ["value"], ["delta"])
    return isolation_flags(stepped, spec, ["value", "value_delta", "hour"]).select(*KEYS, "anomaly_iforest")


@query()
def isolation_forest_hourly(spark, sf_dir):
    df, spec = index_series(hourly(spark, sf_dir, by_station=True), HOURLY)
    return isolation_flags(df, spec, HOURLY_SENSORS).drop(POS)


def _run_params() -> RunParams:
    bounds = {s: (0.0, 1000.0) for s in HOURLY_SENSORS}
    return RunParams(sensors=HOURLY_SENSORS, bounds=bounds, seasonal=DAY)


@query()
def station_run(spark, sf_dir):
    return run_stations(hourly(spark, sf_dir, by_station=True), _run_params()).results


@query(
    f"""WITH {hourly_sql()} SELECT station, "timestamp", concat_ws('; ', {", ".join(
        f"CASE WHEN {s} IS NULL THEN '{s}: missing value' END" for s in HOURLY_SENSORS)}) AS violations
FROM h WHERE {" OR ".join(f"{s} IS NULL" for s in HOURLY_SENSORS)}"""
)
def station_run_rejected(spark, sf_dir):
    _, rejected = split_valid(hourly(spark, sf_dir), _run_params().bounds, HOURLY_SENSORS)
    return rejected.select("station", "timestamp", F.concat_ws("; ", "violations").alias("violations"))


def flagged_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: bounds check, running median, rolling features and z-score flags per station and sensor."""
    valid, _ = split_valid(readings(spark, sf_dir, stations=1), {"value": (0.0, 1000.0)}, ["value"])
    df, spec = index_series(valid, LONG)
    made = rolling_features(df, spec, ["value"], 6)
    return flag_zscores(made, spec, {"anomaly_zscore": ["value"]}, 2.0).drop(POS)
