"""Positions, blocks, rolling features, smoothing and decomposition."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import ordered, same
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barograph.operators import smooth
from barograph.operators.features import adaptive_noise, complete_rows, median_features, rolling_features, running_median
from barograph.operators.seasonal import centered_trend, seasonal_parts
from barograph.operators.smooth import kalman_smooth
from barograph.params import KalmanParams, SeasonalParams
from barograph.plans.layout import Step, block_window, exact_quantile, fill_gaps, index_series, merge_blocks, run_chain, split_blocks

RNG = np.random.default_rng(3)
BLOCKS = (1_000_000, 16)
# One long series next to short ones.
HOT = {(0, "a"): RNG.normal(10, 3, 300).round(2), (0, "b"): RNG.normal(5, 1, 9), (1, "a"): [4.0]}


@pytest.mark.parametrize("block", BLOCKS)
def test_positions_count_rows_in_order(series, block):
    df, spec = series(HOT, block_rows=block)
    indexed, spec = index_series(df, spec)
    pdf = ordered(indexed)
    assert (pdf["pos"] == pdf["seq"]).all()
    assert (spec.longest, spec.shortest) == (300, 1)


def test_equal_times_are_ordered_by_the_last_column(spark):
    from barograph.params import SeriesSpec

    df = spark.range(500).selectExpr("0 AS station", "'a' AS sensor", "TIMESTAMP_NTZ '2025-01-01' AS ts", "id AS seq")
    indexed, _ = index_series(df, SeriesSpec(block_rows=50))
    assert indexed.filter("pos <> seq").count() == 0


def test_blocks_hold_their_halo_and_give_the_rows_back(series):
    df, spec = series(HOT, block_rows=16)
    indexed, spec = index_series(df, spec)
    blocks = split_blocks(indexed, spec, before=20, after=3)
    sizes = blocks.filter("station = 0 AND sensor = 'a'").groupBy("_block").count().toPandas()["count"]
    assert sizes.max() <= 16 + 20 + 3
    assert blocks.filter("_block = 5 AND sensor = 'a' AND station = 0").count() == 39
    assert merge_blocks(blocks, spec).count() == 310


@pytest.mark.parametrize("block", BLOCKS)
def test_rolling_features_equal_pandas(series, block):
    values = HOT | {
        (2, "flat"): [5.0] * 12,
        (2, "ramp"): [5.0] * 6 + [5.0 + 1e-8 * i for i in range(8)],
        (2, "gaps"): [1.0, None, 3.0, 4.0, 5.0, 6.0, 7.0, 9.0, None, 1.0, 2.0, 3.0, 5.0, 8.0, 1.0],
    }
    df, spec = series(values, block_rows=block)
    indexed, spec = index_series(df, spec)
    kinds = ["mean", "std", "skew", "kurt", "min", "max", "delta", "gradient", "energy"]
    pdf = ordered(rolling_features(indexed, spec, ["value"], 6, which=kinds))
    for _, g in pdf.groupby(["station", "sensor"]):
        x = g["value"]
        r = x.rolling(6)
        wanted = {
            "mean": r.mean(), "std": r.std(), "skew": r.skew(), "kurt": r.kurt(), "min": r.min(), "max": r.max(),
            "delta": x.diff(), "gradient": x.diff(6), "energy": (x.diff() ** 2).rolling(6).mean(),
        }
        for kind, w in wanted.items():
            same(g[f"value_{kind}"], w, 1e-6)


def test_a_chain_cuts_blocks_once_and_equals_its_steps(series):
    df, spec = series(HOT, block_rows=16)
    df, spec = index_series(df, spec)
    chained = median_features(df, spec, ["value"], 5, 6)
    alone = running_median(df, spec, ["value"], 5)
    alone = rolling_features(alone, spec, ["value_med"], 6, ["value"])
    def exchanges(made):
        return made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    numbering = exchanges(df)
    assert exchanges(chained) - numbering <= 1 < exchanges(alone) - numbering

    one, other = ordered(chained), ordered(alone)
    assert list(one.columns) == list(other.columns)
    for c in (x for x in one.columns if one[x].dtype.kind == "f"):
        same(one[c], other[c], 1e-9)


def test_a_chain_looks_ahead_and_back(series):
    df, spec = series(HOT, block_rows=7)
    df, spec = index_series(df, spec)

    def near(rows, inner):
        frame = block_window(inner).rowsBetween(-2, 3)
        return rows.withColumn("value", F.sum("value").over(frame))

    got = ordered(run_chain(df, spec, [Step(near, 2, 3), Step(near, 2, 3)]))
    for key, values in HOT.items():
        want = pd.Series(values, dtype=float)
        for _ in range(2):
            want = pd.Series([want[max(0, i - 2) : i + 4].sum() for i in range(len(want))])
        same(got[(got.station == key[0]) & (got.sensor == key[1])]["value"], want, 1e-9)


def test_complete_rows_drops_warmup_or_any_null(series):
    df, spec = series({(0, "a"): [5.0] * 6 + [5.0 + 1e-8 * i for i in range(8)]})
    indexed, spec = index_series(df, spec)
    made = rolling_features(indexed, spec, ["value"], 6)
    assert complete_rows(made, spec, 6, "warmup").count() == 8
    assert complete_rows(made, spec, 6).count() < 8


@pytest.mark.parametrize("block", BLOCKS)
def test_fill_forward_then_from_the_first_value(series, block):
    x = [None, None, 1.0, None, 2.0] + [None] * 40 + [3.0, None]
    df, spec = series({(0, "a"): x, (0, "b"): [None] * 5}, block_rows=block)
    indexed, spec = index_series(df, spec)
    pdf = ordered(fill_gaps(indexed, spec, ["value"]))
    same(pdf.loc[pdf.sensor == "a", "value"], pd.Series(x, dtype=float).ffill().bfill())
    assert pdf.loc[pdf.sensor == "b", "value"].isna().all()


def brute_kalman(values):
    x = pd.Series(values, dtype=float)
    if x.isna().all():
        return x.to_numpy()
    state, error, noise = x.dropna().iloc[0], 1.0, 0.5
    medians, out = [], []
    filled = x.ffill().bfill().to_numpy()
    for i in range(len(filled)):
        medians.append(np.median(filled[max(0, i - 4) : i + 1]))
        recent = medians[-20:]
        if len(recent) >= 5:
            noise = 0.9 * noise + 0.1 * max(np.var(recent), 1e-6)
        error += 0.01
        gain = error / (error + noise)
        state += gain * (medians[-1] - state)
        error *= 1 - gain
        out.append(state)
    return np.array(out)


@pytest.mark.parametrize("block", [1_000_000, 16, 100])
def test_kalman_equals_the_plain_loop(series, block):
    values = HOT | {(3, "gaps"): [None, 3.0, None, 4.0, 9.0, 1.0, None] * 8, (3, "none"): [None] * 20}
    df, spec = series(values, block_rows=block)
    indexed, spec = index_series(df, spec)
    pdf = ordered(kalman_smooth(indexed, spec, ["value"]))
    for key, x in values.items():
        same(pdf[(pdf.station == key[0]) & (pdf.sensor == key[1])]["value_filt"], brute_kalman(x), 1e-11)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), min_size=1, max_size=12), st.integers(0, 2**32 - 1))
def test_scans_equal_loops_over_segments_of_any_length(sizes, seed):
    rng, params = np.random.default_rng(seed), KalmanParams()
    sizes, total = np.array(sizes), sum(sizes)
    chunks, cuts = smooth.Chunks.of(sizes), np.cumsum(sizes)[:-1]
    variance = np.where(rng.random(total) < 0.2, np.nan, rng.exponential(1, total))
    x, starts = rng.normal(10, 3, total), rng.random(len(sizes)) + 0.5
    levels = smooth.noise_levels(chunks, variance, starts, params)
    gain = smooth.gains(chunks, levels, starts, params)
    values = smooth.estimates(chunks, x, gain, starts)
    matrices = smooth.error_matrices(chunks, levels, params)
    for i, (v, m) in enumerate(zip(np.split(variance, cuts), np.split(x, cuts), strict=True)):
        level = error = value = starts[i]
        want = []
        for noise, median in zip(v, m, strict=True):
            if noise == noise:
                level = 0.9 * level + 0.1 * max(noise, params.min_variance)
            predicted = error + params.process_variance
            k = predicted / (predicted + level)
            error, value = (1 - k) * predicted, value + k * (median - value)
            want.append((level, k, value))
        same(np.column_stack((np.split(levels, cuts)[i], np.split(gain, cuts)[i], np.split(values, cuts)[i])), want, 1e-12)
        a, b, c, d = matrices[i]
        assert (a * starts[i] + b) / (c * starts[i] + d) == pytest.approx(error, rel=1e-12)


def test_segments_are_cut_at_key_changes_across_batches():
    import pyarrow as pa

    keys = [1] * 5 + [2] * 9 + [3] * 2 + [4] * 20
    table = pa.table({"k": keys, "v": range(len(keys))})
    for size, rows in ((1, 3), (4, 7), (100, 5), (7, 1000)):
        parts = list(smooth.segments(iter(table.to_batches(size)), ["k"], rows))
        assert pa.concat_tables([t for t, _ in parts]).equals(table)
        assert [n for _, sizes in parts for n in sizes] == [5, 9, 2, 20]
    assert list(smooth.segments(iter([]), ["k"])) == []


def test_median_grows_at_the_start_and_noise_waits_for_five(series):
    df, spec = series({(0, "a"): [5.0, 1.0, 4.0, 2.0, 3.0, 9.0]})
    indexed, spec = index_series(df, spec)
    assert ordered(running_median(indexed, spec, ["value"]))["value_med"].tolist() == [5, 3, 4, 3, 3, 3]
    noise = ordered(adaptive_noise(indexed, spec, ["value"]))["value_var"]
    assert noise.isna().tolist() == [True] * 4 + [False] * 2
    assert noise[5] == pytest.approx(np.var([5, 3, 4, 3, 3, 3]))


def test_scans_hold_few_rows_at_a_time():
    """However many rows a task has, and whole segments still; one long segment is not cut."""
    sizes = [*[151] * 1000, 90_000, *[3] * 20]
    table = pa.table({"k": np.repeat(np.arange(len(sizes)), sizes), "v": np.arange(sum(sizes))})
    empty = table.slice(0, 0).combine_chunks().to_batches() or [pa.RecordBatch.from_pylist([], table.schema)]
    found = list(smooth.segments(iter([*table.to_batches(10_000), *empty]), ["k"]))
    assert np.concatenate([s for _, s in found]).tolist() == sizes
    assert pa.concat_tables([t for t, _ in found]).column("v").to_pylist() == list(range(sum(sizes)))
    assert max(len(t) for t, s in found if len(s) > 1 and s.max() == 151) < 45_000


def brute_parts(values, requested, model="additive"):
    x = pd.Series(values, dtype=float)
    n = len(x)
    p = 2 if n < 8 else min(requested, max(2, n // 3))
    nothing = [np.full(n, np.nan)] * 3
    if x.notna().sum() < 2 * p or (model == "multiplicative" and (x.dropna() <= 0).any()):
        return nothing
    x = x.ffill().bfill().to_numpy()
    half = p // 2
    weights = np.full(p, 1 / p) if p % 2 else np.r_[0.5, np.ones(p - 1), 0.5] / p
    trend = np.full(n, np.nan)
    trend[half : n - half] = np.convolve(x, weights, "valid")
    front, back = half, n - 1 - half
    for lo, hi, at in (
        (front, min(front + p, back), np.arange(front)),
        (max(front, back - p), back, np.arange(back + 1, n)),
    ):
        line = np.linalg.lstsq(np.c_[np.arange(lo, hi), np.ones(hi - lo)], trend[lo:hi], rcond=-1)[0]
        trend[at] = at * line[0] + line[1]
    ratio = model == "multiplicative"
    rest = x / trend if ratio else x - trend
    phases = np.array([rest[i::p].mean() for i in range(p)])
    phases = phases / phases.mean() if ratio else phases - phases.mean()
    season = np.tile(phases, n // p + 1)[:n]
    return trend, season, x / season / trend if ratio else x - trend - season


@pytest.mark.parametrize("block", [1_000_000, 32])
@pytest.mark.parametrize("period", [12, 7])
def test_decomposition_of_every_length(series, block, period):
    lengths = (1, 3, 4, 5, 6, 7, 8, 9, 10, 23, 24, 35, 36, 150)
    values = {(n, "a"): RNG.normal(20, 2, n) + 5 * np.sin(np.arange(n)) for n in lengths}
    values[(200, "gaps")] = [None, *RNG.normal(3, 1, 40), None, 2.0]
    df, spec = series(values, block_rows=block)
    indexed, spec = index_series(df, spec)
    pdf = ordered(seasonal_parts(indexed, spec, ["value"], SeasonalParams(period)))
    for (station, sensor), x in values.items():
        g = pdf[(pdf.station == station) & (pdf.sensor == sensor)]
        for name, wanted in zip(("trend", "seasonal", "residual"), brute_parts(x, period)):
            same(g[f"value_{name}"], wanted, 1e-8)


@pytest.mark.parametrize("block", [1_000_000, 32])
@pytest.mark.parametrize("period", [12, 7, 2])
def test_infinite_and_huge_values_stay_in_their_windows(series, block, period):
    values, rng = {}, np.random.default_rng(6)
    for n in (3 * period - 1, 150):
        x = rng.normal(20, 2, n)
        for name, bad in (("inf", np.inf), ("minus", -np.inf), ("huge", 1e30)):
            values[(n, name)] = [*x[: n // 3], bad, *x[n // 3 + 1 :]]
    df, spec = series(values, block_rows=block)
    indexed, spec = index_series(df, spec)
    pdf = ordered(centered_trend(indexed, spec, ["value"], SeasonalParams(period)))
    for (station, sensor), x in values.items():
        if len(x) < 8:
            continue
        p = min(period, max(2, len(x) // 3))
        half = p // 2
        weights = np.r_[0.5, np.ones(p - 1), 0.5] if p % 2 == 0 else np.ones(p)
        want = np.full(len(x), np.nan)
        for i in range(half, len(x) - half):
            want[i] = (weights * x[i - half : i - half + len(weights)]).sum() / p
        same(pdf[(pdf.station == station) & (pdf.sensor == sensor)]["value_trend"], want)


def test_multiplicative_decomposition_needs_positive_values(series):
    values = {(0, "a"): RNG.uniform(1, 2, 60), (0, "b"): [0.0, *RNG.uniform(1, 2, 59)]}
    df, spec = series(values)
    indexed, spec = index_series(df, spec)
    pdf = ordered(seasonal_parts(indexed, spec, ["value"], SeasonalParams(6, "multiplicative")))
    assert pdf[pdf.sensor == "b"]["value_trend"].isna().all()
    for name, wanted in zip(("trend", "seasonal", "residual"), brute_parts(values[(0, "a")], 6, "multiplicative")):
        same(pdf[pdf.sensor == "a"][f"value_{name}"], wanted, 1e-8)


@pytest.mark.parametrize("block", [1_000_000, 32])
def test_ratios_to_the_trend_with_readings_of_zero(series, block):
    """Without the rule on positive readings a zero is a reading like any other; a season of zeros divides as floats do."""
    x, y = RNG.uniform(1, 2, 60), RNG.uniform(1, 2, 60)
    x[7], y[2::6] = 0.0, 0.0
    df, spec = series({(0, "a"): x, (0, "b"): y}, block_rows=block)
    indexed, spec = index_series(df, spec)
    params = SeasonalParams(6, "multiplicative", positive_only=False)
    pdf = ordered(seasonal_parts(indexed, spec, ["value"], params))
    trend = brute_parts(x, 6)[0]
    phases = np.array([(x / trend)[i::6].mean() for i in range(6)])
    season = np.tile(phases / phases.mean(), 10)
    for name, wanted in (("trend", trend), ("seasonal", season), ("residual", x / season / trend)):
        same(pdf[pdf.sensor == "a"][f"value_{name}"], wanted, 1e-8)
    b = pdf[pdf.sensor == "b"]
    assert (b["value_seasonal"][2::6] == 0).all() and b["value_residual"][2::6].isna().all()
    assert b["value_residual"].notna().sum() == 50


@pytest.mark.parametrize("share", [0.0, 0.25, 0.96, 1.0])
def test_exact_quantile_with_ties(spark, share):
    x = np.r_[np.full(700, 0.5), RNG.random(300)]
    df = spark.createDataFrame([(k, float(v)) for k, part in ((1, x), (2, x[600:])) for v in part], "k long, v double")
    got = {r.k: r.cut for r in exact_quantile(df, ["k"], "v", share, bins=64).collect()}
    assert got[1] == pytest.approx(np.quantile(x, share), abs=1e-12)
    assert got[2] == pytest.approx(np.quantile(x[600:], share), abs=1e-12)


@pytest.mark.parametrize("block", BLOCKS)
def test_longer_windows_use_frames(series, block):
    df, spec = series(HOT | {(2, "gaps"): [1.0, None, *range(40)]}, block_rows=block)
    indexed, spec = index_series(df, spec)
    pdf = ordered(rolling_features(indexed, spec, ["value"], 15, which=["mean", "std", "skew", "kurt", "gradient", "energy"]))
    for _, g in pdf.groupby(["station", "sensor"]):
        x, r = g["value"], g["value"].rolling(15)
        wanted = {"mean": r.mean(), "std": r.std(), "skew": r.skew(), "kurt": r.kurt(), "gradient": x.diff(15)}
        wanted["energy"] = (x.diff() ** 2).rolling(15).mean()
        for kind, w in wanted.items():
            same(g[f"value_{kind}"], w, 1e-6)
