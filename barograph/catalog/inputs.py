"""Readings derived from the driver tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.catalog.registry import laid_out
from barograph.functions.columns import hour_of
from barograph.params import SeriesSpec
from barograph.plans.layout import index_series

LONG = SeriesSpec()
HOURLY = SeriesSpec(("station",), ("timestamp",))
HOURLY_SENSORS = ("ws", "pressure", "rh", "temp", "dew")
# Which event type plays which sensor in the wide frame.
EVENT_SENSORS = {"view": "temp", "click": "rh", "purchase": "pressure", "signup": "ws", "error": "dew"}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def readings(spark: SparkSession, sf_dir: str, stations: int = 8) -> DataFrame:
    """Long readings: every event is a reading of its station and sensor."""
    return events(spark, sf_dir).select(
        (F.col("user_id") % stations).alias("station"),
        F.col("event_type").alias("sensor"),
        "ts",
        F.col("event_id").alias("seq"),
        "value",
    )


def indexed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SeriesSpec]:
    return index_series(readings(spark, sf_dir), laid_out(LONG))


def hourly(spark: SparkSession, sf_dir: str, by_station: bool = False) -> DataFrame:
    """Wide readings: hourly means, one column per sensor; null where nothing was read."""
    station = (F.col("user_id") % 8) if by_station else F.lit(0).cast("long")
    rows = events(spark, sf_dir).select(station.alias("station"), hour_of("ts").alias("timestamp"), "event_type", "value")
    means = [F.avg(F.when(F.col("event_type") == e, F.col("value"))).alias(s) for e, s in EVENT_SENSORS.items()]
    return rows.groupBy("station", "timestamp").agg(*means).select("station", "timestamp", *HOURLY_SENSORS)


def indexed_hourly(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SeriesSpec]:
    return index_series(hourly(spark, sf_dir, True), laid_out(HOURLY))


def raw_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one wide row of text cells, with bad cells planted by row number."""
    text, at = F.col("value").cast("string"), F.col("event_id")
    shown = F.substring(F.col("ts").cast("string"), 1, 19)

    def cell(every: int, bad: str | None):
        return F.when(at % every == 0, F.lit(bad).cast("string")).otherwise(text)

    return events(spark, sf_dir).select(
        (F.col("user_id") % 8).alias("station"),
        at.alias("seq"),
        F.when(at % 11 == 0, F.lit("not a date")).when(at % 13 == 0, F.lit("")).otherwise(shown).alias("timestamp"),
        cell(7, "n/a").alias("temp"),
        cell(17, "").alias("rh"),
        cell(19, "nan").alias("pressure"),
        cell(3, None).alias("ws"),
        cell(5, "--").alias("dew"),
    )


RAW_SENSORS = ("temp", "rh", "pressure", "ws", "dew")

READINGS_SQL = "r AS (SELECT user_id % 8 AS station, event_type AS sensor, ts, event_id AS seq, value FROM events)"
INDEXED_SQL = f"""{READINGS_SQL},
p AS (SELECT *, row_number() OVER (PARTITION BY station, sensor ORDER BY ts, seq) - 1 AS pos,
             count(*) OVER (PARTITION BY station, sensor) AS n FROM r)"""


def hourly_sql(by_station: bool = False) -> str:
    station = "user_id % 8" if by_station else "CAST(0 AS BIGINT)"
    means = ", ".join(
        f"avg(value) FILTER (WHERE event_type = '{e}') AS {s}" for e, s in EVENT_SENSORS.items()
    )
    return f"""h AS (SELECT {station} AS station, date_trunc('hour', ts) AS "timestamp", {means}
 FROM events GROUP BY ALL)"""


RAW_SQL = """b AS (SELECT user_id % 8 AS station, event_id AS seq,
  CASE WHEN event_id % 11 = 0 THEN 'not a date' WHEN event_id % 13 = 0 THEN ''
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "timestamp",
  CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS temp,
  CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(value AS VARCHAR) END AS rh,
  CASE WHEN event_id % 19 = 0 THEN 'nan' ELSE CAST(value AS VARCHAR) END AS pressure,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS ws,
  CASE WHEN event_id % 5 = 0 THEN '--' ELSE CAST(value AS VARCHAR) END AS dew FROM events)"""


def _number(name: str) -> str:
    return f"CASE WHEN isnan(TRY_CAST({name} AS DOUBLE)) THEN NULL ELSE TRY_CAST({name} AS DOUBLE) END AS {name}"


TYPED_SQL = f"""{RAW_SQL},
t AS (SELECT station, seq, TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp",
  {", ".join(_number(s) for s in RAW_SENSORS)} FROM b)"""


def rounded(df: DataFrame, columns, places: int = 4) -> DataFrame:
    """Round computed doubles for comparison; adding 0.0 removes a negative zero."""
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in columns})


def rounded_sql(expression: str, name: str, places: int = 4) -> str:
    return f"round({expression}, {places}) + 0.0 AS {name}"
