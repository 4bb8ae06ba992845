"""Raw readings to typed, complete rows with one row per key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.functions.columns import to_number, to_time
from barograph.params import SENSORS

# Header variants and the column each one stands for.
HEADER_NAMES = {
    "datetime": "timestamp",
    "date time": "timestamp",
    "date_time": "timestamp",
    "timestamp": "timestamp",
    "time": "timestamp",
    "temperature": "temp",
    "temperature_2m": "temp",
    "temp": "temp",
    "rh": "rh",
    "humidity": "rh",
    "relative_humidity": "rh",
    "relative humidity": "rh",
    "pressure": "pressure",
    "pressure_msl": "pressure",
    "ws": "ws",
    "wind_speed": "ws",
    "wind speed": "ws",
    "wd": "wd",
    "wind_direction": "wd",
    "wind direction": "wd",
    "dew": "dew",
    "dew_point": "dew",
    "dew point": "dew",
    "rain": "rain",
    "rainfall": "rain",
    "precipitation": "rain",
}
REQUIRED = ("timestamp", "temp", "rh", "pressure")
ZERO_FILLED = ("rain", "ws", "wd")
DEW_BELOW_TEMP = 5.0

_WHOLE = ("bigint", "int", "smallint", "tinyint")
_FIXED_WIDTH = (*_WHOLE, "double", "float", "boolean", "date", "timestamp", "timestamp_ntz")


def header_name(header: str) -> str:
    """Canonical column name of a header cell."""
    cleaned = header.lstrip("﻿").strip().lower().replace("  ", " ")
    return HEADER_NAMES.get(cleaned) or cleaned.replace(" ", "_")


def canonical_headers(df: DataFrame, headers: Iterable[str] | None = None) -> DataFrame:
    """Rename columns; several sources of one name are coalesced in header order.

    ``headers`` are the raw header cells where they differ from the column names.
    """
    positional = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    sources: dict[str, list[str]] = {}
    for i, header in enumerate(headers or df.columns):
        sources.setdefault(header_name(header), []).append(f"_c{i}")
    return positional.select(
        *[(F.coalesce(*found) if len(found) > 1 else F.col(found[0])).alias(name) for name, found in sources.items()]
    )


def select_sensors(df: DataFrame, sensors: Iterable[str] = SENSORS, keep: Iterable[str] = ()) -> DataFrame:
    """Project to timestamp, sensors and ``keep``; a missing sensor becomes null."""
    present = set(df.columns)
    return df.select(
        "timestamp",
        *[F.col(s) if s in present else F.lit(None).cast("double").alias(s) for s in sensors],
        *[c for c in keep if c in present],
    )


def data_columns(df: DataFrame, sensors: Iterable[str] = SENSORS) -> dict[str, str]:
    """The column to compute on, by sensor: the smoothed one if present, else the raw one."""
    options = {s: [c for c in (f"{s}_filt", s) if c in df.columns] for s in sensors}
    return {s: found[0] for s, found in options.items() if found}


def coerce_types(df: DataFrame, sensors: Iterable[str] = SENSORS) -> DataFrame:
    """Cast timestamp and sensors; what cannot be read becomes null."""
    return df.withColumns({"timestamp": to_time("timestamp"), **{s: to_number(s) for s in sensors}})


def fill_rules(df: DataFrame) -> DataFrame:
    """Missing rain and wind are 0; missing dew lies a fixed step below temp."""
    fills = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ZERO_FILLED if c in df.columns}
    if "dew" in df.columns:
        fills["dew"] = F.coalesce(F.col("dew"), F.col("temp") - DEW_BELOW_TEMP)
    return df.withColumns(fills) if fills else df


def drop_incomplete(df: DataFrame, required: Iterable[str] = REQUIRED) -> DataFrame:
    """Drop rows without one of the required columns."""
    return df.dropna(subset=list(required))


def keep_last(df: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """One row per key: the last one in ``order``.

    An aggregate, not a window: copies of one key are combined before the shuffle,
    so a key with very many copies does not gather them in one task. Fixed-width
    columns ordered by one whole number are hashed; other rows are sorted first.
    """
    keys, order = list(keys), list(order)
    types = dict(df.dtypes)
    rest = [c for c in df.columns if c not in keys]
    if len(order) == 1 and types[order[0]] in _WHOLE and all(types[c] in _FIXED_WIDTH for c in rest):
        # Every column sees the same rows in the same order, so all agree on the row.
        rank = F.coalesce(F.col(order[0]).cast("long"), F.lit(-(2**63)))
        return df.groupBy(*keys).agg(*[F.max_by(c, rank).alias(c) for c in rest]).select(*df.columns)
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    picked = df.groupBy(*keys).agg(last)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns])


def normalize(
    df: DataFrame,
    sensors: Iterable[str] = SENSORS,
    keys: Iterable[str] = ("timestamp",),
    order: Iterable[str] = ("seq",),
) -> DataFrame:
    """Header names, types, fills, required columns, last row per key.

    ``keys`` and ``order`` name columns the reader adds next to the headers.
    A frame without a timestamp column gives no rows.
    """
    sensors, keys, order = list(sensors), list(keys), list(order)
    named = canonical_headers(df)
    if "timestamp" not in named.columns:
        named = named.withColumn("timestamp", F.lit(None).cast("string"))
    extra = [c for c in [*keys, *order] if c not in ("timestamp", *sensors)]
    typed = coerce_types(select_sensors(named, sensors, extra), sensors)
    required = [c for c in REQUIRED if c in typed.columns]
    return keep_last(drop_incomplete(fill_rules(typed), required), keys, order)
