"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Windows with a population variance up to this count as noise around a constant.
TINY_VARIANCE = 1e-14

_NUMBER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy")


def flag(condition: Column) -> Column:
    """0/1 flag; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def no_nan(column: Column) -> Column:
    """NaN becomes null: Spark sorts NaN above every number."""
    return F.when(~F.isnan(column), column)


def to_number(column: str) -> Column:
    """Text to double; anything that is not a number becomes null."""
    text = F.trim(F.col(column).cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_time(column: str, formats: Iterable[str] = TIME_FORMATS) -> Column:
    """Text to zone-less timestamp; text in no known format becomes null."""
    text = F.trim(F.col(column).cast("string"))
    parsed = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(text.try_cast("timestamp_ntz"), *parsed)


def hour_of(column: str) -> Column:
    """Start of the hour; stays zone-less, unlike ``date_trunc``."""
    return F.expr(f"{column} - make_dt_interval(0, 0, minute({column}), extract(second from {column}))")


def full_window(value: Column, counted: Column, rows: int) -> Column:
    """``value`` only where the frame holds ``rows`` non-null readings."""
    return F.when(counted == rows, value)


def window_skew(stats: Mapping[str, Column], rows: int) -> Column:
    """Bias-corrected skewness of a frame of ``rows`` values; 0 for a constant frame."""
    if rows < 3:
        return F.lit(None).cast("double")
    correction = (rows * (rows - 1)) ** 0.5 / (rows - 2)
    return F.when(stats["max"] == stats["min"], F.lit(0.0)).when(
        stats["var"] > TINY_VARIANCE, stats["skewness"] * correction
    )


def window_kurtosis(stats: Mapping[str, Column], rows: int) -> Column:
    """Bias-corrected excess kurtosis of a frame of ``rows`` values; -3 for a constant frame."""
    if rows < 4:
        return F.lit(None).cast("double")
    scale = (rows - 1) / ((rows - 2) * (rows - 3))
    return F.when(stats["max"] == stats["min"], F.lit(-3.0)).when(
        stats["var"] > TINY_VARIANCE, (stats["kurtosis"] * (rows + 1) + 6) * scale
    )


def median_of(values: Column) -> Column:
    """Median of an array without nulls; the mean of the middle two when even."""
    ordered = F.sort_array(values)
    n = F.size(ordered)
    upper = F.get(ordered, F.floor(n / 2).cast("int"))
    lower = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    return F.when(n > 0, (lower + upper) / 2)


def capped_period(requested: int, rows: str) -> Column:
    """Season length that leaves at least three seasons; 2 below eight rows."""
    wanted = max(2, int(requested))
    n = F.col(rows)
    return (
        F.when(n < 8, F.lit(2))
        .otherwise(F.least(F.lit(wanted), F.greatest(F.lit(2), F.floor(n / 3))))
        .cast("long")
    )


def capped_season(requested: int, rows: str, min_seasons: int) -> Column:
    """Seasonal lag of the forecaster that leaves ``min_seasons`` seasons."""
    wanted, seasons = max(2, int(requested)), max(2, int(min_seasons))
    n = F.col(rows)
    return (
        F.when(n < seasons + 20, F.lit(2))
        .otherwise(F.least(F.lit(wanted), F.greatest(F.lit(2), F.floor(n / seasons))))
        .cast("long")
    )
