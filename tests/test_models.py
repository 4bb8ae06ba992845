"""Forecasts, flags, isolation forest and drift."""

from dataclasses import replace
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pytest
from conftest import ordered, same
from pyspark.sql import functions as F

from barograph.catalog import QUERIES
from barograph.catalog.inputs import indexed as indexed_events
from barograph.functions import sarima
from barograph.operators.anomaly import combine_flags, error_flag, mean_impute, zscore_flags
from barograph.operators.drift import drift_samples, exact_p, ks_drift, ks_statistic, retrain_list
from barograph.operators.forecast import forecast_plan, forecast_series, mask_warmup, tail_mean
from barograph.operators.forest import PRIME, grow_forest, isolation_flags, isolation_scores, tree_samples
from barograph.operators.lagmodel import LagModel, fit_lag_model, lag_forecast, lag_windows, rolling_lag_forecast
from barograph.operators.report import alert_summary, alerts, markdown_report
from barograph.operators.sarima import fit_sarima, forecast_ahead, refresh_models, rolling_sarima
from barograph.operators.scaling import minmax_scale
from barograph.params import DriftParams, ForecastParams, ForestParams, SarimaParams
from barograph.plans.layout import attach, index_series, series_sizes

RNG = np.random.default_rng(11)
BLOCKS = (1_000_000, 32)


def seasonal_moving_average(n, theta, season_theta, m, seed=5):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1, n + m + 1)
    w = e.copy()
    for t in range(m + 1, len(e)):
        w[t] = e[t] + theta * e[t - 1] + season_theta * e[t - m] + theta * season_theta * e[t - m - 1]
    w = w[m + 1 :]
    x = np.zeros(n)
    for t in range(n):  # undo (1 - B)(1 - B^m)
        a = x[t - 1] if t else 0.0
        b = x[t - m] if t >= m else 0.0
        c = x[t - m - 1] if t > m else 0.0
        x[t] = w[t] + a + b - c
    return x


def test_sarima_recovers_known_parameters():
    x = seasonal_moving_average(1500, -0.4, -0.6, 12)
    model = sarima.fit(x, SarimaParams(season=12), 12)
    assert model.theta == pytest.approx([-0.4, -0.6], abs=0.08)
    assert model.sigma == pytest.approx(1.0, abs=0.1)


def test_sarima_autoregressive_orders():
    rng, x = np.random.default_rng(2), [0.0]
    for _ in range(1200):
        x.append(0.7 * x[-1] + rng.normal())
    params = SarimaParams(order=(1, 0, 0), seasonal_order=(0, 0, 0))
    model = sarima.fit(np.array(x), params, 2)
    assert model.theta == pytest.approx([0.7], abs=0.06)
    assert sarima.spread_of(model, 3) == pytest.approx(model.sigma * np.sqrt(np.cumsum([1, 0.49, 0.2401])), rel=0.2)


@pytest.mark.parametrize("season", [1, 6, 50])
def test_innovations_equal_the_plain_recursion(season):
    w = RNG.normal(size=80)
    ma = np.zeros(8)
    ma[[0, 1, 6, 7]] = 1.0, 0.3, -0.5, -0.15
    e = sarima.innovations(w, np.array([[1.0]]), ma[None, :], season)[:, 0]
    plain = []
    for t in range(80):
        plain.append(w[t] - sum(ma[k] * plain[t - k] for k in range(1, 8) if t >= k))
    same(e, plain)


def test_too_few_values_give_no_model():
    assert sarima.fit(np.arange(29.0), SarimaParams(season=2), 2) is None


SMALL = ForecastParams(
    sarima=SarimaParams(season=12, min_seasons=4), lookback=12, horizon=1, history_rows=90, tail_rows=60, primary="value"
)


def wave(n, seed=1, noise=0.3):
    t = np.arange(n)
    return 20 + 5 * np.sin(2 * np.pi * t / 12) + np.random.default_rng(seed).normal(0, noise, n)


@pytest.mark.parametrize("block", BLOCKS)
def test_rolling_sarima_beats_the_last_value_and_never_looks_ahead(series, block):
    x = wave(200)
    changed = x.copy()
    changed[170:] += 100.0
    df, spec = series({(0, "a"): x, (1, "a"): changed, (2, "short"): x[:20]}, block_rows=block)
    indexed, spec = index_series(df, spec)
    made = ordered(rolling_sarima(indexed, spec, ["value"], forecast_plan(indexed, spec, SMALL), SMALL))
    assert set(made.station) == {0, 1}
    a, b = made[made.station == 0], made[made.station == 1]
    assert a["pos"].tolist() == list(range(140, 200))
    same(a["value_forecast"][:31], b["value_forecast"][:31])
    assert np.abs(a["value_forecast"] - x[140:]).mean() < 0.4 * np.abs(np.diff(x)[139:]).mean()
    assert ((a["value_lower"] < x[140:]) & (x[140:] < a["value_upper"])).mean() > 0.8


@pytest.mark.parametrize("orders", [((0, 1, 1), (0, 1, 1)), ((1, 0, 1), (0, 1, 0)), ((0, 1, 0), (0, 0, 0))])
def test_samples_fitted_side_by_side_are_fitted_as_if_alone(orders):
    params, rng = SarimaParams(*orders, season=12), np.random.default_rng(4)
    samples = [seasonal_moving_average(n, -0.4, -0.6, 12, seed=n) for n in (20, 60, 90, 91, 90)]
    samples[4][[0, 7, 50]] = np.nan
    models = sarima.fit_many(samples, params, 12)
    assert models[0] is None
    aheads = [rng.normal(size=n) for n in (6, 9, 3, 9)]
    aheads[1][[2, 3]] = np.nan
    forecasts = sarima.one_step_forecasts(models[1:], samples[1:], aheads)
    for model, x, ahead, forecast in zip(models[1:], samples[1:], aheads, forecasts, strict=True):
        same(model.theta, sarima.fit(x, params, 12).theta)
        x = x[~np.isnan(x)]
        for value, made in zip(ahead, forecast, strict=True):
            assert made == pytest.approx(sarima.next_values(model, x, sarima.observed_innovations(model, x), 1)[0])
            x = np.append(x, value) if value == value else x


def test_origins_share_the_rows_of_a_span(series, monkeypatch):
    """A row is copied for a span of origins and not for each of them; the spans change no forecast."""
    from barograph.operators import sarima as operator

    df, spec = series({(0, "a"): wave(200), (1, "a"): [*wave(70), None, None, *wave(50)]})
    indexed, spec = index_series(df, spec)
    params, made = replace(SMALL, tail_rows=0, refit_rows=5), []
    for origins in (1, 4, 32):
        monkeypatch.setattr(operator, "_ORIGINS", origins)
        forecasts = rolling_sarima(indexed, spec, ["value"], forecast_plan(indexed, spec, params), params)
        made.append(ordered(forecasts))
    for other in made[1:]:
        assert other["pos"].tolist() == made[0]["pos"].tolist()
        for part in ("forecast", "lower", "upper"):
            same(made[0][f"value_{part}"], other[f"value_{part}"])


def test_forecast_ahead_continues_the_wave(series):
    df, spec = series({(0, "a"): wave(240, noise=0.05)})
    indexed, spec = index_series(df, spec)
    params = replace(SMALL, history_rows=240)
    made = ordered(forecast_ahead(indexed, spec, "value", forecast_plan(indexed, spec, params), params, 12), ("step",))
    truth = 20 + 5 * np.sin(2 * np.pi * np.arange(240, 252) / 12)
    assert np.abs(made["forecast"] - truth).max() < 0.5
    assert (made["upper"] - made["lower"]).is_monotonic_increasing
    models = fit_sarima(indexed, spec, "value", forecast_plan(indexed, spec, params), params.sarima).first()
    assert (models.season, models.trained_rows, len(models.theta)) == (12, 240, 2)


def brute_tail_mean(x, rows, history):
    out = []
    for i in range(len(x)):
        seen = [v for v in x[max(0, i - history) : i] if v is not None]
        out.append(np.mean(seen[-rows:]) if seen else np.nan)
    return out


@pytest.mark.parametrize("block", BLOCKS)
def test_tail_mean_skips_gaps_within_its_history(series, block):
    x = [1.0, None, 3.0, None, None, 4.0, 7.0] * 6 + [None] * 12 + [2.0, 5.0]
    df, spec = series({(0, "a"): x}, block_rows=block)
    indexed, spec = index_series(df, spec)
    pdf = ordered(tail_mean(indexed, spec, ["value"], rows=3, history=8))
    same(pdf["forecast_value"], brute_tail_mean(x, 3, 8))


def test_tail_mean_adds_in_the_order_of_the_rows(series):
    """To the last bit, so that an error on the threshold falls on the side of the mean over a frame."""
    df, spec = series({(0, "a"): [0.1, 0.2, 0.3, 1.0]})
    indexed, spec = index_series(df, spec)
    pdf = ordered(tail_mean(indexed, spec, ["value"], rows=3))
    assert pdf["forecast_value"][3] == (0.1 + 0.2 + 0.3) / 3 != (0.3 + 0.2 + 0.1) / 3


def test_lag_windows_hold_the_rows_around(series):
    df, spec = series({(0, "a"): [1.0, 2.0, 3.0, 4.0, 5.0]})
    indexed, spec = index_series(df, spec)
    rows = ordered(lag_windows(indexed, spec, ["value"], 2, 2))
    assert [list(v) for v in rows["lags"]] == [[1, 2], [2, 3]]
    assert [list(v) for v in rows["targets"]] == [[3, 4], [4, 5]]


@pytest.mark.parametrize("block", BLOCKS)
def test_lag_model_learns_a_planted_signal(spark, series, block, folder):
    x = wave(400, noise=0.1)
    df, spec = series({(0, "a"): x, (1, "a"): wave(300, 9, 0.1)}, block_rows=block)
    indexed, spec = index_series(df, spec)
    params = replace(SMALL, use_sarima=False)
    plan = forecast_plan(indexed, spec, params)
    model = fit_lag_model(indexed, spec, ["value"], plan, params)
    made = ordered(lag_forecast(indexed, spec, ["value"], plan, params, model))
    got = made[made.station == 0]
    assert got["pos"].tolist() == list(range(340, 400))
    error = np.abs(got["value_forecast"].to_numpy() - x[340:]).mean()
    assert error < 0.25 * np.abs(np.array(brute_tail_mean(x.tolist(), 3, 360))[340:] - x[340:]).mean()
    assert 0 < model.validation_rmse["value"] < 0.05
    model.save(spark, f"{folder}/model")
    again = ordered(lag_forecast(indexed, spec, ["value"], plan, params, LagModel.load(spark, f"{folder}/model", ["value"])))
    same(again["value_forecast"], made["value_forecast"])


def test_registered_forecasts_cover_every_position(spark):
    df, spec = indexed_events(spark, "/root/testdata/sf0.01")
    for name, first in (("rolling_origin", 54), ("lag_model", 43)):
        made = QUERIES[name](spark, "/root/testdata/sf0.01")
        wanted = df.filter(F.col("pos") >= first).select("station", "sensor", "pos")
        got = made.select("station", "sensor", "pos")
        assert got.count() == got.distinct().count() == wanted.count()
        assert wanted.subtract(got).count() == 0


@pytest.mark.parametrize("name", ["isolation_forest_hourly", "station_run"])
def test_registered_runs_work_per_station(spark, name):
    made = QUERIES[name](spark, "/root/testdata/sf0.1")
    assert {r.station for r in made.select("station").distinct().collect()} == set(range(8))


@pytest.mark.parametrize("block", BLOCKS)
def test_rolling_lag_model_never_looks_ahead(series, block):
    x = wave(400, noise=0.1)
    changed = x.copy()
    changed[250:] += 100.0
    params = replace(SMALL, use_sarima=False, lookback=24, tail_rows=0)
    made = []
    for values in (x, changed):
        df, spec = series({(0, "a"): values, (1, "b"): wave(90, 4), (2, "short"): x[:20]}, block_rows=block)
        indexed, spec = index_series(df, spec)
        plan = forecast_plan(indexed, spec, params)
        made.append(ordered(rolling_lag_forecast(indexed, spec, ["value"], plan, params)))
    a, b = (m[m.station == 0] for m in made)
    assert a["pos"].tolist() == list(range(43, 400))
    assert made[0][made[0].station == 1]["pos"].tolist() == list(range(43, 90))
    assert not (made[0].station == 2).any()
    same(a["value_forecast"][: 251 - 43], b["value_forecast"][: 251 - 43])
    assert np.abs(a["value_forecast"] - x[43:])[57:].mean() < 0.5 * np.abs(np.diff(x)[99:]).mean()


def test_lag_model_equals_direct_ridge(series):
    x = wave(200, noise=0.5)
    df, spec = series({(0, "a"): x}, block_rows=50)
    indexed, spec = index_series(df, spec)
    params = replace(SMALL, use_sarima=False, lookback=4)
    model = fit_lag_model(indexed, spec, ["value"], forecast_plan(indexed, spec, params), params)
    start = 140
    low, high = x[:start].min(), x[:start].max()
    z = (x - low) / (high - low)
    a = np.array([[1, *z[i - 4 : i]] for i in range(4, int(start * 0.8))])
    y = np.array([z[i] - z[i - 1] for i in range(4, int(start * 0.8))])
    held = np.array([[1, *z[i - 4 : i]] for i in range(int(start * 0.8), start)])
    held_y = np.array([z[i] - z[i - 1] for i in range(int(start * 0.8), start)])
    options = []
    for ridge in (1e-4, 1e-3, 1e-2, 1e-1):
        penalty = ridge * len(a) * np.diag([0, 1, 1, 1, 1])
        beta = np.linalg.solve(a.T @ a + penalty, a.T @ y)
        options.append((np.sqrt(np.mean((held @ beta - held_y) ** 2)), beta))
    rmse, beta = min(options, key=lambda o: o[0])
    same(model.coefficients[:, 0], beta, 1e-6)
    assert model.validation_rmse["value"] == pytest.approx(rmse, rel=1e-6)


def test_forecast_modes(series):
    df, spec = series({(0, "a"): wave(200), (1, "a"): wave(25)})
    indexed, spec = index_series(df, spec)
    assert forecast_series(indexed, spec, ["value"], params=replace(SMALL, use_sarima=False, use_lag_model=False)) is indexed
    full = ordered(forecast_series(indexed, spec, ["value"], params=SMALL))
    one, other = full[full.station == 0], full[full.station == 1]
    assert one["forecast_value"].notna().tolist() == [False] * 140 + [True] * 60
    assert one["forecast_error"].notna().sum() == 60 - 48
    assert other["forecast_value"].isna().all()
    only = ordered(forecast_series(indexed, spec, ["value"], params=replace(SMALL, use_lag_model=False)))
    seasonal = ordered(rolling_sarima(indexed, spec, ["value"], forecast_plan(indexed, spec, SMALL), SMALL))
    same(only[only.station == 0]["forecast_value"][140:], seasonal["value_forecast"])
    filled = ordered(forecast_series(indexed, spec, ["value"], params=replace(SMALL, use_lag_model=False, fill=True)))
    assert filled[filled.station == 0]["forecast_value"].notna().all()


def test_origin_guards(series):
    df, spec = series({(0, "a"): wave(29), (1, "a"): wave(30), (2, "a"): wave(2000)})
    plan = {r.station: r for r in forecast_plan(df, spec).collect()}
    assert plan[0].start == 29
    assert (plan[1].season, plan[1].start) == (2, 29)
    assert (plan[2].season, plan[2].start) == (60, 1400)
    fast = {r.station: r.start for r in forecast_plan(df, spec, ForecastParams(fast=True)).collect()}
    assert fast[2] == 1880


@pytest.mark.parametrize("block", BLOCKS)
def test_zscores_share_one_aggregate(series, block):
    x = np.r_[RNG.normal(0, 1, 99), 30.0]
    df, spec = series({(0, "a"): x, (0, "flat"): [5.0] * 40, (0, "one"): [1.0]}, block_rows=block)
    indexed, spec = index_series(df, spec)
    wide = indexed.withColumn("other", F.when(F.col("pos") != 3, F.col("value")))
    pdf = ordered(zscore_flags(wide, spec, {"z": ["value", "other"], "o": ["other"]}, 3.0))
    flagged = pdf[pdf.z == 1]
    assert flagged[["sensor", "pos"]].to_numpy().tolist() == [["a", 99]]
    assert pdf["o"].sum() == 1


def test_combined_flag_holds_every_flag(spark):
    df = spark.createDataFrame([(a, b) for a in (0, 1) for b in (0, 1)], "a int, b int")
    rows = combine_flags(df, ["a", "b"]).collect()
    assert all(r.anomaly_combined == max(r.a, r.b) and r.anomaly == (-1 if r.anomaly_combined else 1) for r in rows)


def test_error_flag_ignores_missing_errors(spark):
    df = spark.createDataFrame(
        [(5.0, 1.0, 1.0), (3.9, 1.0, 1.0), (None, None, 0.0)],
        "forecast_error double, forecast_error_mean double, forecast_error_std double",
    )
    assert [r[0] for r in df.select(error_flag()).collect()] == [1, 0, 0]
    assert [r[0] for r in df.select(error_flag("fixed", 4.0)).collect()] == [1, 0, 0]


def test_warmup_mask(series):
    df, spec = series({(0, "a"): [1.0] * 6})
    indexed, _ = index_series(df, spec)
    masked = mask_warmup(indexed.withColumn("start", F.lit(2)), 2, columns=["value"])
    assert ordered(masked)["value"].isna().tolist() == [False, False, True, True, False, False]


def test_impute_and_scale(series):
    df, spec = series({(0, "a"): [1.0, None, 3.0], (0, "flat"): [2.0, 2.0]}, block_rows=2)
    indexed, spec = index_series(df, spec)
    assert ordered(mean_impute(indexed, spec, ["value"]))["value"].tolist() == [1, 2, 3, 2, 2]
    same(ordered(minmax_scale(indexed, spec, ["value"]))["value_scaled"], [0, np.nan, 1, 0, 0])


@pytest.mark.parametrize("block", BLOCKS)
def test_forest_flags_planted_outliers(series, block):
    x = RNG.normal(0, 1, 500)
    x[[50, 250, 400]] = 15.0, -14.0, 20.0
    df, spec = series({(0, "a"): x, (1, "a"): RNG.normal(0, 1, 40), (2, "a"): [None, None]}, block_rows=block)
    indexed, spec = index_series(df, spec)
    wide = indexed.withColumn("half", F.col("value") / 2)
    made = ordered(isolation_flags(wide, spec, ["value", "half"]))
    one = made[made.station == 0]
    assert one[one["pos"].isin([50, 250, 400])]["anomaly_iforest"].tolist() == [1, 1, 1]
    assert one["anomaly_iforest"].mean() == pytest.approx(0.04, abs=0.005)
    assert made[made.station == 2]["anomaly_iforest"].tolist() == [0, 0]


def test_each_tree_is_drawn_from_the_whole_series(series):
    """The smallest hashes, also when the first cut leaves too few rows, and all rows of short series."""
    df, spec = series({(0, "a"): wave(900), (1, "a"): wave(12), (2, "a"): [1.0]}, block_rows=100)
    df, spec = index_series(df, spec)
    params = ForestParams(trees=7, sample_rows=20, seed=5)
    sized = attach(df, series_sizes(df, spec), spec)
    got = ordered(tree_samples(sized, spec, params), ("station", "tree", "place"))

    def number(pos, tree):
        one = (pos * 48271 + tree * 69621 + 5) % PRIME
        two = (one * one + tree * 16807 + pos) % PRIME
        return (two * two + one) % PRIME

    for station, n in ((0, 900), (1, 12), (2, 1)):
        for tree in range(7):
            want = sorted(range(n), key=lambda pos: (number(pos, tree), pos))[:20]
            assert got[(got.station == station) & (got.tree == tree)]["pos"].tolist() == want
    drawn = got[got.station == 0].groupby("pos").size()
    assert len(drawn) > 100 and drawn.max() < 7  # trees differ


def test_rows_are_drawn_in_compiled_code(series, monkeypatch):
    """The hashes of all rows and trees are most of the work; a lambda over the trees is interpreted for each of them."""
    from barograph.operators import forest as operator

    plans, write = [], operator.materialize

    def watch(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(operator, "materialize", watch)
    df, spec = index_series(*series({(0, "a"): wave(90)}))
    tree_samples(attach(df, series_sizes(df, spec), spec), spec, ForestParams(trees=7, sample_rows=20))
    assert len(plans) == 1 and "lambda" not in plans[0]


def test_a_split_between_neighbouring_numbers_leaves_both_sides():
    x = np.array([[1.0], [np.nextafter(1.0, 2.0)]] * 8)
    for seed in range(20):
        forest = grow_forest(x, np.arange(16).reshape(2, 8), np.random.default_rng(seed), 3)
        inner = forest["feature"] >= 0
        assert (forest["left"][inner] + 1 < len(forest["left"])).all() and inner.sum() == 2


def test_forest_is_repeatable_and_independent_of_blocks(series):
    values = {(0, "a"): RNG.normal(0, 1, 300), (1, "b"): RNG.normal(5, 2, 90)}
    scores = []
    for block in (1_000_000, 1_000_000, 40):
        df, spec = series(values, block_rows=block)
        indexed, spec = index_series(df, spec)
        scores.append(ordered(isolation_scores(indexed, spec, ["value"], ForestParams(trees=20)))["score"])
    same(scores[0], scores[1])
    same(scores[0], scores[2])


@pytest.mark.parametrize(("m", "n"), [(4, 6), (5, 5), (3, 7)])
def test_exact_p_equals_all_splits(m, n):
    order = range(m + n)
    distances = []
    for chosen in combinations(order, m):
        i = j = worst = 0
        for k in order:
            if k in chosen:
                i += 1
            else:
                j += 1
            worst = max(worst, abs(i * n - j * m))
        distances.append(worst)
    for h in sorted(set(distances)):
        assert exact_p(h, m, n) == pytest.approx(sum(d >= h for d in distances) / comb(m + n, m), abs=1e-12)


def test_drift_of_equal_disjoint_and_tied_samples(spark):
    def samples(rows):
        data = [(k, s, float(v)) for k, s, values in rows for v in values]
        return spark.createDataFrame(data, "k string, sample string, value double")

    rows = [
        ("same", "baseline", range(20)), ("same", "comparison", range(20)),
        ("apart", "baseline", range(20)), ("apart", "comparison", range(100, 115)),
        ("ties", "baseline", [1] * 10 + [2] * 10), ("ties", "comparison", [1] * 15 + [2] * 5),
        ("small", "baseline", range(9)), ("small", "comparison", range(100, 120)),
    ]
    got = {r.k: r for r in ks_drift(samples(rows), ["k"]).collect()}
    assert (got["same"].d, got["same"].p_value, got["same"].drift) == (0.0, 1.0, 0)
    assert (got["apart"].d, got["apart"].drift) == (1.0, 1)
    assert got["apart"].p_value == pytest.approx(2 / comb(35, 15))
    assert got["ties"].d == pytest.approx(0.25)
    assert (got["small"].p_value, got["small"].drift) == (1.0, 0)
    events = ks_drift(samples(rows), ["k"])
    done = spark.createDataFrame([("other",)], "k string")
    assert [r.k for r in retrain_list(events, done, ["k"]).collect()] == ["apart"]


@pytest.mark.parametrize("block", BLOCKS)
def test_drift_samples_take_both_ends(series, block):
    df, spec = series({(0, "a"): range(300), (0, "b"): range(50), (0, "c"): range(49)}, block_rows=block)
    indexed, spec = index_series(df, spec)
    made = drift_samples(indexed, spec, ["value"], DriftParams()).toPandas()
    ends = made.groupby(["sensor", "sample"])["value"].agg(["min", "max", "count"])
    assert ends.loc[("a", "baseline")].tolist() == [0, 119, 120]
    assert ends.loc[("a", "comparison")].tolist() == [240, 299, 60]
    assert ends.loc[("b", "baseline")].tolist() == [0, 24, 25]
    assert ends.loc[("b", "comparison")].tolist() == [25, 49, 25]
    assert "c" not in set(made["sensor"])
    assert ks_statistic(drift_samples(indexed, spec, ["value"]), spec.keys).count() == 2


def test_alerts_and_reports(spark):
    rows = [(s, i, int(i % 4 == 0)) for s in ("a", "b") for i in range(40)] + [("c", 0, 0)]
    df = spark.createDataFrame(rows, "station string, ts int, anomaly_combined int")
    got = {r.station: r for r in alert_summary(df, ["station"]).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].total_records, got["a"].anomaly_count, got["a"].anomaly_pct) == (40, 10, 25.0)
    assert alert_summary(df, ["station"], 0).count() == 3
    sample = alerts(df, ["station"], ["ts"]).filter("station = 'a'").first().sample
    assert [r.ts for r in sample] == [0, 4, 8, 12, 16]
    text = spark.createDataFrame([("a", 1, "x|y\nz"), ("a", 2, None), ("a", 3, "w")], "station string, n int, note string")
    document = markdown_report(text, ["station"], ["n", "note"], ["n"], max_rows=2).first().document
    assert document.split("\n") == [
        "# Predicted Atmospheric Data", "", "- Total CSV rows: 3", "- Rows included in this upload: 2", "",
        "| n | note |", "| --- | --- |", "| 1 | x\\|y z |", "| 2 |  |", "",
    ]


def test_no_forecast_when_nothing_is_long_enough(series):
    df, spec = series({(0, "a"): wave(20)})
    indexed, spec = index_series(df, spec)
    made = ordered(forecast_series(indexed, spec, ["value"], params=SMALL))
    assert pd.isna(made["forecast_value"]).all() and pd.isna(made["forecast_error"]).all()


def test_only_listed_models_are_fitted_anew(spark, series):
    df, spec = series({(0, "a"): wave(80), (1, "a"): wave(80, 3)})
    indexed, spec = index_series(df, spec)
    plan = forecast_plan(indexed, spec, SMALL)
    old = fit_sarima(indexed, spec, "value", plan, SMALL.sarima).withColumn("sigma", F.lit(-1.0))
    listed = spark.createDataFrame([(1, "a")], "station long, sensor string")
    made = {r.station: r.sigma for r in refresh_models(old, listed, indexed, spec, "value", plan, SMALL.sarima).collect()}
    assert made[0] == -1.0 and made[1] > 0


def test_lag_model_without_a_usable_window_is_absent(series):
    df, spec = series({(0, "a"): wave(60), (1, "a"): [None, 1.0] * 40})
    indexed, spec = index_series(df, spec)
    params = replace(SMALL, use_sarima=False, lookback=40, tail_rows=0)
    plan = forecast_plan(indexed, spec, params)
    assert fit_lag_model(indexed, spec, ["value"], plan, params) is None
    assert lag_forecast(indexed, spec, ["value"], plan, params).count() == 0
