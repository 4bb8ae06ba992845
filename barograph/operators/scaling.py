"""Min-max scaling of each series to its own range."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.params import SeriesSpec
from barograph.plans.layout import attach

FLAT_RANGE = 1e-6


def scale_limits(df: DataFrame, spec: SeriesSpec, columns: Iterable[str], rows: Column | None = None) -> DataFrame:
    """Per series: rows ``n`` and the range of each column, over the chosen rows."""
    columns = list(columns)
    chosen = F.lit(True) if rows is None else rows
    return df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(F.when(chosen, F.col(c))).alias(f"{c}_low") for c in columns],
        *[F.max(F.when(chosen, F.col(c))).alias(f"{c}_high") for c in columns],
    )


def _width(column: str) -> Column:
    low, high = F.col(f"{column}_low"), F.col(f"{column}_high")
    return F.when(high == low, F.lit(FLAT_RANGE)).otherwise(high - low)


def scaled(column: str) -> Column:
    return (F.col(column) - F.col(f"{column}_low")) / _width(column)


def unscaled(value: Column, column: str) -> Column:
    return value * _width(column) + F.col(f"{column}_low")


def minmax_scale(df: DataFrame, spec: SeriesSpec, columns: Iterable[str]) -> DataFrame:
    """Add ``<column>_scaled`` for each column."""
    columns = list(columns)
    wide = attach(df, scale_limits(df, spec, columns), spec)
    out = wide.withColumns({f"{c}_scaled": scaled(c) for c in columns})
    return out.select(*df.columns, *[f"{c}_scaled" for c in columns])
