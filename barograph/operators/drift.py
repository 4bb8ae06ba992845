"""Distribution drift: two-sample Kolmogorov-Smirnov test per series."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from barograph.params import DriftParams, SeriesSpec
from barograph.plans.layout import POS, with_size

_TERMS = 100


def drift_samples(
    df: DataFrame, spec: SeriesSpec, columns: Iterable[str], params: DriftParams = DriftParams(), sensor: str = "sensor"
) -> DataFrame:
    """First rows against last rows of each series, long: keys, sensor, sample, value.

    Only the two ends are kept, so every later step sees a bounded number of rows
    per series. Too short series give no rows.
    """
    columns = list(columns)
    sized = with_size(df.select(*spec.keys, POS, *columns), spec)
    n = F.col("n")
    sized = sized.withColumn("_b", F.least(F.lit(params.baseline_rows), F.floor(n / 2)))
    sized = sized.withColumn("_c", F.least(F.lit(params.comparison_rows), n - F.col("_b")))
    big = (n >= params.min_rows) & (F.col("_b") >= params.min_sample) & (F.col("_c") >= params.min_sample)
    ends = F.array(
        F.when(F.col(POS) < F.col("_b"), F.lit("baseline")), F.when(F.col(POS) >= n - F.col("_c"), F.lit("comparison"))
    )
    picked = sized.filter(big).withColumn("sample", F.explode(F.array_compact(ends)))
    if len(columns) == 1 and sensor in spec.keys:
        out = picked.withColumnRenamed(columns[0], "value").select(*spec.keys, "sample", POS, "value")
    else:
        out = picked.unpivot([*spec.keys, "sample", POS], columns, sensor, "value")
    return out.filter(F.col("value").isNotNull())


def ks_statistic(samples: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Per series: sample sizes ``n1``, ``n2`` and the largest distance ``d`` of the two ECDFs.

    Counts are accumulated over distinct values, so ties step together.
    """
    keys = list(keys)
    counts = samples.groupBy(*keys, "value").agg(
        F.count(F.when(F.col("sample") == "baseline", 1)).alias("_a"),
        F.count(F.when(F.col("sample") == "comparison", 1)).alias("_b"),
    )
    upto = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    steps = counts.select(
        *keys,
        F.sum("_a").over(upto).alias("_ca"),
        F.sum("_b").over(upto).alias("_cb"),
        F.sum("_a").over(whole).alias("n1"),
        F.sum("_b").over(whole).alias("n2"),
    )
    # Whole steps of 1/(n1 n2): an integer distance keeps the exact test exact.
    gap = F.abs(F.col("_ca") * F.col("n2") - F.col("_cb") * F.col("n1"))
    return (
        steps.groupBy(*keys, "n1", "n2")
        .agg(F.max(gap).alias("h"))
        .withColumn("d", F.col("h") / (F.col("n1") * F.col("n2")))
    )


def asymptotic_p() -> Column:
    """Limit distribution of the statistic, as an expression over ``d``, ``n1``, ``n2``."""
    x = F.col("d") * F.col("d") * F.col("n1") * F.col("n2") / (F.col("n1") + F.col("n2"))
    terms = F.sequence(F.lit(1), F.lit(_TERMS))
    total = F.aggregate(
        terms, F.lit(0.0), lambda s, k: s + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x)
    )
    return F.when(F.col("d") == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * total)))


def exact_p(h: int, m: int, n: int) -> float:
    """Probability that two samples of one distribution lie at least ``h / (m n)`` apart.

    A random merge of the samples is a walk over counts (i, j); the chance to
    reach a point with ``|i n - j m| >= h`` is summed step by step.
    """
    if h <= 0:
        return 1.0
    i = np.arange(m + 1, dtype=float)
    inside = np.zeros(m + 1)
    inside[0] = 1.0
    reached = 0.0
    for s in range(1, m + n + 1):
        left = m + n - s + 1.0
        j_before = s - 1 - i
        stay = inside * np.clip(n - j_before, 0, None) / left
        move = np.zeros(m + 1)
        move[1:] = inside[:-1] * (m - i[:-1]) / left
        inside = stay + move
        out = np.abs(i * n - (s - i) * m) >= h
        reached += inside[out].sum()
        inside[out] = 0.0
    return float(min(max(reached, 0.0), 1.0))


@F.pandas_udf(DoubleType())
def _exact_p(h: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([exact_p(int(a), int(b), int(c)) for a, b, c in zip(h, m, n)], dtype=float)


def ks_drift(samples: DataFrame, keys: Iterable[str], params: DriftParams = DriftParams()) -> DataFrame:
    """Statistic, p-value (by ``params.method``) and drift flag per series; too small samples have p = 1."""
    tested = ks_statistic(samples, keys)
    small = (F.col("n1") < params.min_sample) | (F.col("n2") < params.min_sample)
    value = _exact_p("h", "n1", "n2") if params.method == "exact" else asymptotic_p()
    p = F.when(small, F.lit(1.0)).otherwise(value)
    return tested.withColumn("p_value", p).withColumn("drift", (F.col("p_value") < params.p_threshold).cast("int"))


def drift_flags(tested: DataFrame, keys: Iterable[str]) -> DataFrame:
    """1 where any tested series of the group drifted."""
    return tested.groupBy(*keys).agg(F.max("drift").alias("drift"))


def retrain_list(events: DataFrame, consumed: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Series with a drift event no refit has consumed yet."""
    keys = list(keys)
    return events.filter(F.col("drift") == 1).select(*keys).distinct().join(consumed, keys, "left_anti")
