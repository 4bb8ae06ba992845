"""Models per series against numpy, and the table that says which are fitted anew."""

import numpy as np
import pytest
from conftest import ordered, same

from barograph.operators.forecast import forecast_plan
from barograph.operators.seriesmodel import SeriesModelParams, SeriesModels, fit_series_models, merged, series_forecast
from barograph.params import ForecastParams
from barograph.plans.layout import index_series
from barograph.sources.models import ModelTable

PLAN = ForecastParams(use_sarima=False, lookback=4, horizon=1, tail_rows=20)


def walk(n, seed, gap=()):
    rng = np.random.default_rng(seed)
    x = np.empty(n)
    x[0] = 50 * seed
    for i in range(1, n):
        x[i] = 0.7 * x[i - 1] + 15 * seed + rng.normal()
    return [None if i in gap else float(v) for i, v in enumerate(x)]


def plain_fit(values, start, lookback, ridge):
    """Ridge on centred windows, written out."""
    x = np.array([np.nan if v is None else v for v in values])
    rows = [(x[i - lookback : i], x[i] - x[i - 1]) for i in range(lookback, start)]
    rows = [(a, y) for a, y in rows if not np.isnan(a).any() and not np.isnan(y)]
    a, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    c = a - a.mean(axis=0)
    left = c.T @ c / len(a)
    beta = np.linalg.solve(left + ridge * np.diag(np.diag(left)), c.T @ (y - y.mean()) / len(a))
    return len(a), y.mean() - beta @ a.mean(axis=0), beta


SERIES = {(0, "a"): walk(120, 1, (30, 31)), (0, "b"): walk(90, 2), (1, "a"): walk(60, 3)}


@pytest.mark.parametrize("block", [1000, 16])
def test_series_models_equal_numpy(series, block):
    df, spec = series(SERIES, block_rows=block)
    df, spec = index_series(df, spec)
    plan = forecast_plan(df, spec, PLAN)
    fitted = fit_series_models(df, spec, ["value"], plan, SeriesModelParams(4, 0.05))
    found = {(r.station, r.sensor): r for r in fitted.collect()}
    assert set(found) == set(SERIES)
    forecasts = series_forecast(df, spec, ["value"], plan, SeriesModels(fitted, 4))
    made = {k: g.set_index("pos")["value_forecast"] for k, g in ordered(forecasts).groupby(["station", "sensor"])}
    for key, values in SERIES.items():
        n = len(values)
        count, intercept, beta = plain_fit(values, n - 20, 4, 0.05)
        assert found[key].windows == count
        same([found[key].intercept, *found[key].coefficients], [intercept, *beta], 1e-8)
        x = np.array(values[-24:], float)
        want = [x[i - 1] + intercept + beta @ x[i - 4 : i] for i in range(4, 24)]
        same(made[key].reindex(range(n - 20, n)), want, 1e-8)


def test_wide_columns_have_models_of_their_own(spark, series):
    from barograph.params import SeriesSpec

    df, _ = series({(0, "a"): walk(80, 1), (1, "a"): walk(80, 4)})
    df = df.selectExpr("station", "ts", "seq", "value AS u_filt", "value * 2 AS v_filt")
    df, spec = index_series(df, SeriesSpec(("station",), ("ts", "seq"), block_rows=16))
    plan = forecast_plan(df, spec, PLAN)
    only = spark.createDataFrame([("1", "v")], "station string, sensor string")
    args = (df, spec, ["u_filt", "v_filt"], plan, SeriesModelParams(2), ["u", "v"])
    every = {(r.station, r.sensor): r for r in fit_series_models(*args).collect()}
    listed = fit_series_models(*args, only=only.selectExpr("cast(station AS long) AS station", "sensor")).collect()
    assert set(every) == {(s, c) for s in (0, 1) for c in "uv"}
    assert [(r.station, r.sensor) for r in listed] == [(1, "v")] and listed[0].intercept == every[1, "v"].intercept
    same(every[0, "u"].coefficients, every[0, "v"].coefficients, 1e-9)  # the unit of a sensor doesn't matter
    forecasts = series_forecast(df, spec, ["u_filt", "v_filt"], plan, SeriesModels(fit_series_models(*args, only=only), 2), ["u", "v"])
    made = ordered(forecasts, ("station", "pos"))
    assert made["u_filt_forecast"].isna().all() and made["v_filt_forecast"].notna().sum() == 20


def test_short_and_constant_series(series):
    df, spec = series({(0, "a"): [1.0] * 60, (1, "a"): walk(9, 1), (2, "a"): [None] * 60})
    df, spec = index_series(df, spec)
    plan = forecast_plan(df, spec, PLAN)
    fitted = fit_series_models(df, spec, ["value"], plan, SeriesModelParams(4))
    assert [(r.station, r.intercept, list(r.coefficients)) for r in fitted.collect()] == [(0, 0.0, [0.0] * 4)]
    empty, sized = index_series(df.drop("pos").limit(0), spec)
    assert fit_series_models(empty, sized, ["value"], forecast_plan(empty, sized, PLAN)).count() == 0


def test_merging_keeps_digits_far_from_zero():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)) + 1e8
    parts = [(len(p), p.mean(axis=0), (p - p.mean(axis=0)).T @ (p - p.mean(axis=0))) for p in np.array_split(x, 7)]
    n, mean, products = merged([(0, np.zeros(3), np.zeros((3, 3))), *parts])
    assert n == 400
    np.testing.assert_allclose(products, (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)), rtol=1e-6)


def test_the_table_lists_stale_and_drifted_series_once(spark, folder):
    table = ModelTable(folder, ("temp", "rh"), "temp", 4)
    keys = "station string, sensor string"
    every = [(s, c) for s in "ab" for c in ("temp", "rh")]
    series = spark.createDataFrame(every, keys)

    def listed(t=table):
        return sorted(tuple(r) for r in t.to_refit(spark, series).collect())

    def commit(rows, run):
        shape = "station string, sensor string, windows long, intercept double, coefficients array<double>, rmse double"
        table.commit(spark.createDataFrame([(*r, 9, float(run), [0.0], 1.0) for r in rows], shape), run)

    def drift(rows, run):
        shape = "station string, sensor string, p_value double, drift int"
        table.add_events(spark.createDataFrame([(s, f"{c}_filt", 0.01, d) for s, c, d in rows], shape), run)

    assert listed() == sorted(every)
    commit(every[:3], 1)
    assert listed() == [("b", "rh")]
    drift([("a", "temp", 1), ("a", "rh", 0), ("z", "temp", 1)], 1)
    assert listed() == [("a", "temp"), ("b", "rh")]
    commit([("b", "rh")], 2)  # a run that fits one of them leaves the other event open
    assert listed() == [("a", "temp")]
    commit([("a", "temp")], 2)
    assert listed() == []
    drift([("a", "temp", 1)], 2)  # found by the run that fitted it: open for the next one
    assert listed() == [("a", "temp")]
    commit([("a", "temp")], 3)
    assert listed() == []
    assert listed(ModelTable(folder, ("temp", "rh"), "rh", 4)) == sorted(every)
    fitted = spark.createDataFrame([("b", "rh", 7.0, [1.0])], f"{keys}, intercept double, coefficients array<double>")
    use = table.valid(spark, fitted.select("station", "sensor"), fitted).collect()
    assert {(r.station, r.sensor): r.intercept for r in use} == {
        ("a", "temp"): 3.0, ("a", "rh"): 1.0, ("b", "temp"): 1.0, ("b", "rh"): 7.0,
    }
