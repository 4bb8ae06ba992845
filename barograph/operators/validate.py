"""Bounds checks: valid rows and quarantined rows with their violations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.functions.columns import to_number
from barograph.params import BOUNDS, SENSORS

VIOLATIONS = "violations"


def _violation(name: str, dtype: str, low: float, high: float) -> Column:
    raw = F.col(name)
    value = to_number(name) if dtype == "string" else raw.cast("double")
    missing = raw.isNull() | (F.isnan(value) if dtype in ("double", "float") else F.lit(False))
    shown = F.concat(F.lit(f"{name}="), value.cast("string"))
    return (
        F.when(missing, F.lit(f"{name}: missing value"))
        .when(value.isNull(), F.lit(f"{name}: invalid type/value"))
        .when(value < low, F.concat(shown, F.lit(f" below min {low}")))
        .when(value > high, F.concat(shown, F.lit(f" above max {high}")))
    )


def check_bounds(
    df: DataFrame,
    bounds: Mapping[str, tuple[float, float]] = BOUNDS,
    sensors: Iterable[str] = SENSORS,
) -> DataFrame:
    """Add ``violations``: one message per sensor out of its inclusive bounds.

    Messages come in bounds order; a null in a sensor without bounds counts too.
    Columns that are absent are skipped. One projection, no shuffle.
    """
    dtypes = dict(df.dtypes)
    checks = [_violation(c, dtypes[c], low, high) for c, (low, high) in bounds.items() if c in dtypes]
    checks += [
        F.when(F.col(c).isNull(), F.lit(f"{c}: missing value")) for c in sensors if c in dtypes and c not in bounds
    ]
    found = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return df.withColumn(VIOLATIONS, found)


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)


def quarantine_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(VIOLATIONS) > 0)


def split_valid(df: DataFrame, bounds=BOUNDS, sensors=SENSORS) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows) of a frame."""
    checked = check_bounds(df, bounds, sensors)
    return valid_rows(checked), quarantine_rows(checked)
