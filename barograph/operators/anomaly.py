"""Anomaly flags and their combination."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.functions.columns import flag
from barograph.params import SeriesSpec
from barograph.plans.layout import attach

DETECTORS = ("anomaly_iforest", "anomaly_zscore", "anomaly_residual", "anomaly_forecast_error")


def series_stats(df: DataFrame, spec: SeriesSpec, columns: Iterable[str]) -> DataFrame:
    """Per series: rows ``n``, mean and sample deviation of each column."""
    return df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[e for c in columns for e in (F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"))],
    )


def zscore_flags(df: DataFrame, spec: SeriesSpec, flags: Mapping[str, Iterable[str]], threshold: float = 3.0):
    """Add one flag per entry: any of its columns lies more than ``threshold`` deviations off its mean.

    Aggregate and join, not a whole-series window; all flags share one aggregate.
    ``df`` is read twice, so write an expensive frame down first. A flat series
    never flags, nor does a null.
    """
    flags = {name: list(columns) for name, columns in flags.items()}
    work = {c: f"_v_{c}" for c in dict.fromkeys(c for columns in flags.values() for c in columns)}
    stats = series_stats(df.select(*spec.keys, *[F.col(c).alias(v) for c, v in work.items()]), spec, work.values())
    joined = attach(df, stats, spec)

    def far(c: str) -> Column:
        mean, std = F.col(f"{work[c]}_mean"), F.col(f"{work[c]}_std")
        return flag((std > 0) & (F.abs((F.col(c) - mean) / std) > threshold))

    found = {name: [far(c) for c in columns] for name, columns in flags.items()}
    added = {name: F.greatest(*hits) if len(hits) > 1 else hits[0] for name, hits in found.items()}
    return joined.withColumns(added).select(*df.columns, *added)


def error_flag(mode: str = "adaptive", threshold: float = 2.5, k: float = 3.0) -> Column:
    """Forecast-error flag: above a fixed threshold, or above mean + k deviations."""
    limit = F.col("forecast_error_mean") + k * F.col("forecast_error_std") if mode == "adaptive" else F.lit(threshold)
    return flag(F.col("forecast_error") > limit)


def combine_flags(df: DataFrame, detectors: Iterable[str] = DETECTORS) -> DataFrame:
    """``anomaly_combined`` is 1 if any detector flags; ``anomaly`` is -1 or 1."""
    found = [F.col(d) for d in detectors]
    combined = F.greatest(*found) if len(found) > 1 else found[0]
    df = df.withColumn("anomaly_combined", combined)
    return df.withColumn("anomaly", F.when(F.col("anomaly_combined") == 1, -1).otherwise(1))


def outlier_label(column: str = "anomaly") -> Column:
    return F.when(F.col(column) == -1, "Outlier").otherwise("Normal")


def anomalous(df: DataFrame) -> DataFrame:
    """Rows flagged by the combined flag, or else by the -1 mark; else none."""
    if "anomaly_combined" in df.columns:
        return df.filter(F.col("anomaly_combined") == 1)
    if "anomaly" in df.columns:
        return df.filter(F.col("anomaly") == -1)
    return df.limit(0)


def mean_impute(df: DataFrame, spec: SeriesSpec, columns: Iterable[str]) -> DataFrame:
    """Replace nulls by the mean of the column in its series."""
    columns = list(columns)
    work = {c: f"_v_{c}" for c in columns}
    means = df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(v) for c, v in work.items()]
    )
    joined = attach(df, means.withColumnRenamed("n", "_n").withColumn("n", F.col("_n")), spec)
    return joined.select(*[F.coalesce(c, work[c]).alias(c) if c in work else F.col(c) for c in df.columns])


def detector_counts(df: DataFrame, keys: Iterable[str] = (), detectors: Iterable[str] = DETECTORS) -> DataFrame:
    """Rows and flagged rows per detector."""
    counted = [*detectors, "anomaly_combined"]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(d).cast("long").alias(d) for d in counted])
