"""Rolling features over the last rows of each series."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.functions.columns import full_window, median_of, window_kurtosis, window_skew
from barograph.params import KalmanParams, SeriesSpec
from barograph.plans.layout import Step, block_window, merge_blocks, run_chain, split_blocks

_STATISTICS = {
    "count": lambda x, d, frame, rows, w: F.count(x).over(frame),
    "avg": lambda x, d, frame, rows, w: F.avg(x).over(frame),
    "var": lambda x, d, frame, rows, w: F.var_pop(x).over(frame),
    "min": lambda x, d, frame, rows, w: F.min(x).over(frame),
    "max": lambda x, d, frame, rows, w: F.max(x).over(frame),
    "skewness": lambda x, d, frame, rows, w: F.skewness(x).over(frame),
    "kurtosis": lambda x, d, frame, rows, w: F.kurtosis(x).over(frame),
    "back": lambda x, d, frame, rows, w: F.lag(x, rows).over(w),
    "power": lambda x, d, frame, rows, w: F.avg(d * d).over(frame),
    "steps": lambda x, d, frame, rows, w: F.count(d).over(frame),
}
_NEEDS = {
    "mean": ("count", "avg"),
    "std": ("count", "var"),
    "skew": ("count", "var", "min", "max", "skewness"),
    "kurt": ("count", "var", "min", "max", "kurtosis"),
    "min": ("count", "min"),
    "max": ("count", "max"),
    "gradient": ("back",),
    "energy": ("power", "steps"),
}
# Up to this many rows a window is computed from lag columns.
LAG_WINDOW = 12
FEATURES = ("mean", "std", "skew", "kurt", "gradient", "energy")
RATIO_GUARD = 1e-6


def rolling_features(
    df: DataFrame,
    spec: SeriesSpec,
    columns: Iterable[str],
    window: int = 6,
    names: Iterable[str] | None = None,
    which: Iterable[str] = FEATURES,
) -> DataFrame:
    """Add the chosen features of each column, null until ``window`` readings exist.

    ``which`` may also hold ``min``, ``max`` and ``delta``. ``names`` gives the
    output prefixes. All columns share one block window: one shuffle, one sort. A
    short window is computed from lag columns, as compiled arithmetic on one row; a
    longer one from sliding frames.
    """
    columns, which = list(columns), list(which)
    names = list(names or columns)
    blocks = split_blocks(df, spec, before=window)
    build = _from_lags if window <= LAG_WINDOW else _from_frames
    blocks, helpers = build(blocks, spec, dict(zip(names, columns)), window, which)
    return merge_blocks(blocks, spec).drop(*helpers)


def _from_lags(blocks: DataFrame, spec: SeriesSpec, columns: dict[str, str], window: int, which: list[str]):
    w = block_window(spec)
    deep = window if {"gradient", "energy"} & set(which) else window - 1
    lags = {f"_{i}_{n}": F.lag(c, i).over(w) for n, c in columns.items() for i in range(1, deep + 1)}
    blocks = blocks.withColumns(lags)
    moments, central, added = {}, {}, {}
    for n, c in columns.items():
        x = [F.col(c).cast("double"), *[F.col(f"_{i}_{n}").cast("double") for i in range(1, deep + 1)]]
        frame, mean = x[:window], F.col(f"_mean_{n}")
        # A sum with a missing reading is null, so a null mean marks an incomplete window.
        moments[f"_mean_{n}"] = _total(frame) / window
        off = [v - mean for v in frame]
        for power in (2, 3, 4):
            central[f"_m{power}_{n}"] = _total([reduce(mul, [d] * power) for d in off]) / window
        if window > 1:
            low, high = F.least(*frame), F.greatest(*frame)
        else:
            low = high = frame[0]
        m2, m3, m4 = (F.col(f"_m{power}_{n}") for power in (2, 3, 4))
        stats = {
            "min": low,
            "max": high,
            "var": m2,
            "skewness": m3 / F.pow(m2, F.lit(1.5)),
            "kurtosis": m4 / (m2 * m2) - 3,
        }
        full = mean.isNotNull()
        steps = [x[i] - x[i + 1] for i in range(len(x) - 1)]
        made = {
            "mean": lambda: mean,
            "std": lambda: F.sqrt(m2 * (window / (window - 1))) if window > 1 else F.lit(None).cast("double"),
            "skew": lambda: F.when(full, window_skew(stats, window)),
            "kurt": lambda: F.when(full, window_kurtosis(stats, window)),
            "min": lambda: F.when(full, low),
            "max": lambda: F.when(full, high),
            "delta": lambda: steps[0],
            "gradient": lambda: x[0] - x[window],
            "energy": lambda: _total([d * d for d in steps[:window]]) / window,
        }
        added.update({f"{n}_{kind}": made[kind]() for kind in which})
    return blocks.withColumns(moments).withColumns(central).withColumns(added), [*lags, *moments, *central]


def _total(parts: list[Column]) -> Column:
    return reduce(add, parts)


def _from_frames(blocks: DataFrame, spec: SeriesSpec, columns: dict[str, str], window: int, which: list[str]):
    w = block_window(spec)
    frame = w.rowsBetween(-(window - 1), 0)
    deltas = {f"_d_{n}": F.col(c) - F.lag(c).over(w) for n, c in columns.items()}
    blocks = blocks.withColumns(deltas)
    # Each frame statistic is one column, shared by the features that need it.
    stats, added = {}, {}
    for n, column in columns.items():
        x, delta = F.col(column), F.col(f"_d_{n}")
        needed = set().union(*(_NEEDS.get(kind, ()) for kind in which))
        stats.update({f"_{kind}_{n}": _STATISTICS[kind](x, delta, frame, window, w) for kind in needed})
        c = {kind: F.col(f"_{kind}_{n}") for kind in _STATISTICS}
        seen = c["count"]
        made = {
            "mean": lambda: full_window(c["avg"], seen, window),
            "std": lambda: full_window(F.sqrt(c["var"] * (window / (window - 1))), seen, window),
            "skew": lambda: full_window(window_skew(c, window), seen, window),
            "kurt": lambda: full_window(window_kurtosis(c, window), seen, window),
            "min": lambda: full_window(c["min"], seen, window),
            "max": lambda: full_window(c["max"], seen, window),
            "delta": lambda: delta,
            "gradient": lambda: x - c["back"],
            "energy": lambda: full_window(c["power"], c["steps"], window),
        }
        added.update({f"{n}_{kind}": made[kind]() for kind in which})
    blocks = blocks.withColumns(stats) if stats else blocks
    return blocks.withColumns(added), [*deltas, *stats]


def composite_ratios(df: DataFrame) -> DataFrame:
    """Temperature-humidity ratio and pressure-temperature product.

    Each sensor is read from ``_mean``, else ``_filt``, else the raw column; a
    ratio whose sensors are absent is left out.
    """

    def source(sensor: str) -> str | None:
        options = (f"{sensor}_mean", f"{sensor}_filt", sensor)
        return next((c for c in options if c in df.columns), None)

    temp, rh, pressure = source("temp"), source("rh"), source("pressure")
    added = {}
    if temp and rh:
        added["temp_rh_ratio"] = F.col(temp) / (F.col(rh) + RATIO_GUARD)
    if temp and pressure:
        added["pressure_temp_product"] = F.col(pressure) * F.col(temp)
    return df.withColumns(added) if added else df


def running_median(df: DataFrame, spec: SeriesSpec, columns: Iterable[str], window: int = 5, suffix: str = "_med"):
    """Median of the last ``window`` readings; the frame grows at the series start."""
    frame = block_window(spec).rowsBetween(-(window - 1), 0)
    blocks = split_blocks(df, spec, before=window - 1)
    medians = {f"{c}{suffix}": median_of(F.collect_list(c).over(frame)) for c in columns}
    return merge_blocks(blocks.withColumns(medians), spec)


def median_features(
    df: DataFrame,
    spec: SeriesSpec,
    columns: Iterable[str],
    median_window: int = 5,
    window: int = 6,
    which: Iterable[str] = FEATURES,
) -> DataFrame:
    """Running median of each column and the chosen features of these medians, in one exchange."""
    columns, which = list(columns), list(which)
    medians = [f"{c}_med" for c in columns]
    return run_chain(df, spec, [
        Step(lambda rows, inner: running_median(rows, inner, columns, median_window), median_window - 1),
        Step(lambda rows, inner: rolling_features(rows, inner, medians, window, columns, which), window),
    ])


def adaptive_noise(df: DataFrame, spec: SeriesSpec, columns: Iterable[str], params: KalmanParams = KalmanParams()):
    """Running medians and their recent population variance, the measurement noise."""
    columns, w = list(columns), block_window(spec)
    near = w.rowsBetween(-(params.median_window - 1), 0)
    far = w.rowsBetween(-(params.history - 1), 0)
    blocks = split_blocks(df, spec, before=params.median_window + params.history - 2)
    blocks = blocks.withColumns({f"{c}_med": median_of(F.collect_list(c).over(near)) for c in columns})
    old_enough = F.col("pos") >= params.min_history - 1
    noise = {f"{c}_var": F.when(old_enough, F.var_pop(f"{c}_med").over(far)) for c in columns}
    return merge_blocks(blocks.withColumns(noise), spec)


def complete_rows(df: DataFrame, spec: SeriesSpec, window: int, drop: str = "any") -> DataFrame:
    """Drop rows with any null, or with ``drop="warmup"`` only the first ``window`` rows.

    Write computed features down first: the optimizer would move the filter below
    them and compute them twice. Index the rows again afterwards.
    """
    if drop == "warmup":
        return df.filter(F.col("pos") >= window)
    return df.dropna("any")
