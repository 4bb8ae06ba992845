"""Queries that write files or streams derived from the tables and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from barograph.catalog.inputs import HOURLY_SENSORS, READINGS_SQL, hourly, hourly_sql, indexed, readings, rounded, rounded_sql
from barograph.catalog.registry import query
from barograph.catalog.windows import KALMAN_ROWS, KEYS
from barograph.operators.anomaly import zscore_flags
from barograph.operators.report import alert_summary
from barograph.session import work_path
from barograph.sources.csvfiles import scan_readings
from barograph.sources.master import MasterTable, ingest
from barograph.streaming.ingest import first_within, stream_alerts, stream_ingest
from barograph.streaming.smooth import stream_smooth as smooth_stream, stream_smooth_table

SENSORS = tuple(HOURLY_SENSORS)
_NAMES = {"timestamp": "DateTime", "ws": "WS", "pressure": "Pressure", "rh": "RH", "temp": "Temp", "dew": "Dew"}
_OLD_NAMES = {"timestamp": "time", "ws": "wind speed", "pressure": "pressure_msl", "rh": "humidity", "temp": "temperature"}

# What reading back gives: rows without a required sensor go, wind and dew are filled.
CLEAN_SQL = f"""{hourly_sql(True)},
c AS (SELECT CAST(station AS VARCHAR) AS station, "timestamp", coalesce(ws, 0.0) AS ws, pressure, rh, temp,
  coalesce(dew, temp - 5.0) AS dew FROM h WHERE temp IS NOT NULL AND rh IS NOT NULL AND pressure IS NOT NULL)"""
_COLUMNS = ", ".join(rounded_sql(s, s) for s in SENSORS)
CLEAN_ROWS = f'WITH {CLEAN_SQL} SELECT station, "timestamp", {_COLUMNS} FROM c'


def _written(df, names, path, sep=","):
    cells = df.select("station", *[F.col(c).cast("string").alias(n) for c, n in names.items()])
    cells.write.option("header", True).option("sep", sep).csv(path)


def _clean(df):
    return rounded(df.select("station", "timestamp", *SENSORS), SENSORS)


@query(CLEAN_ROWS)
def scan_csv_dir(spark, sf_dir):
    """Two files sets with different headers; the later one wins."""
    root, rows = work_path(spark, "csv"), hourly(spark, sf_dir, True)
    _written(rows.withColumns({s: F.col(s) + 1 for s in SENSORS}).drop("dew"), _OLD_NAMES, f"{root}/a")
    _written(rows, _NAMES, f"{root}/b")
    return _clean(scan_readings(spark, root, SENSORS))


@query(CLEAN_ROWS)
def scan_tsv(spark, sf_dir):
    """Tab-separated, with a byte-order mark before the first header."""
    root = work_path(spark, "tsv")
    marked = hourly(spark, sf_dir, True).select("timestamp", "station", *SENSORS)
    names = {"timestamp": "﻿DateTime", "station": "station", **{s: _NAMES[s] for s in SENSORS}}
    cells = marked.select(*[F.col(c).cast("string").alias(n) for c, n in names.items()])
    cells.write.option("header", True).option("sep", "\t").csv(root)
    return _clean(scan_readings(spark, root, SENSORS))


@query(CLEAN_ROWS)
def master_replace(spark, sf_dir):
    master = MasterTable(work_path(spark, "master"), SENSORS)
    path = work_path(spark, "csv")
    _written(hourly(spark, sf_dir, True), _NAMES, path)
    snapshot = scan_readings(spark, path, SENSORS)
    master.replace(snapshot.withColumns({s: F.col(s) + 1 for s in SENSORS}))
    master.replace(snapshot)
    return _clean(master.read(spark))


@query(
    f"""WITH {CLEAN_SQL}, u AS (SELECT *, 0 AS batch FROM c
 UNION ALL SELECT station, "timestamp" + INTERVAL 12 DAY, ws + 1, pressure + 1, rh + 1, temp + 1, dew + 1, 1 FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY station, "timestamp" ORDER BY batch DESC) AS rn FROM u)
SELECT station, "timestamp", {_COLUMNS} FROM k WHERE rn = 1"""
)
def master_upsert(spark, sf_dir):
    master = MasterTable(work_path(spark, "master"), SENSORS)
    path = work_path(spark, "csv")
    _written(hourly(spark, sf_dir, True), _NAMES, path)
    rows = scan_readings(spark, path, SENSORS)
    master.upsert(rows)
    later = rows.withColumns({s: F.col(s) + 1 for s in SENSORS})
    master.upsert(later.withColumn("timestamp", F.expr("timestamp + INTERVAL 12 DAY")))
    return _clean(master.read(spark))


@query(
    f"""WITH {CLEAN_SQL}, o AS (SELECT count(*) AS n FROM c),
t AS (SELECT count(*) AS n FROM (SELECT station, "timestamp" FROM c UNION SELECT station, "timestamp" + INTERVAL 12 DAY FROM c))
SELECT CAST(0 AS BIGINT) AS batch, n AS new_rows, n AS total_rows FROM o WHERE n > 0
UNION ALL SELECT CAST(1 AS BIGINT), t.n - o.n, t.n FROM t, o WHERE o.n > 0"""
)
def master_ledger(spark, sf_dir):
    master = MasterTable(work_path(spark, "master"), SENSORS)
    path = work_path(spark, "csv")
    _written(hourly(spark, sf_dir, True), _NAMES, path)
    rows = scan_readings(spark, path, SENSORS)
    master.upsert(rows)
    master.upsert(rows.withColumn("timestamp", F.expr("timestamp + INTERVAL 12 DAY")))
    return master.commits(spark).select("batch", "new_rows", "total_rows")


@query(CLEAN_ROWS)
def ingest_fallback(spark, sf_dir):
    """No snapshot: the stream folder fills the master."""
    stream = work_path(spark, "landing")
    _written(hourly(spark, sf_dir, True), _NAMES, stream)
    master = MasterTable(work_path(spark, "master"), SENSORS)
    return _clean(ingest(spark, master, stream, snapshot_path=work_path(spark, "missing")))


@query(CLEAN_ROWS)
def stream_first_wins(spark, sf_dir):
    """Repeated keys of a stream are dropped with bounded state: the copies of the second arrival change nothing."""
    landing, out = work_path(spark, "landing"), work_path(spark, "first")
    path = work_path(spark, "csv")
    _written(hourly(spark, sf_dir, True), _NAMES, path)
    rows = scan_readings(spark, path, SENSORS)
    for part in (rows, rows.withColumns({s: F.col(s) + 1 for s in SENSORS})):
        part.write.mode("append").parquet(landing)
        stream = first_within(spark.readStream.schema(rows.schema).parquet(landing), delay="365 days")
        writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    return _clean(spark.read.parquet(out))


@query(CLEAN_ROWS)
def scan_mixed_headers(spark, sf_dir):
    """Files with other names, column orders and separators in one folder; each line is read by its file's header."""
    root, rows = work_path(spark, "mixed"), hourly(spark, sf_dir, True)
    part = F.pmod(F.xxhash64("station", "timestamp"), F.lit(3))
    _written(rows.where(part == 0), _NAMES, f"{root}/a")
    _written(rows.where(part == 1), dict(reversed(_OLD_NAMES.items())) | {"dew": "dew point"}, f"{root}/b")
    _written(rows.where(part == 2), {"temp": "TEMP", **_NAMES}, f"{root}/c", "\t")
    return _clean(scan_readings(spark, root, SENSORS))


@query(KALMAN_ROWS)
def stream_smooth_blocks(spark, sf_dir):
    """Smoothing of a stream with its state in a table, each arrival cut into blocks."""
    landing, out = work_path(spark, "landing"), work_path(spark, "smoothed")
    rows = readings(spark, sf_dir)
    edges = rows.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    middle = F.lit(edges["low"] + (edges["high"] - edges["low"]) / 2).cast("timestamp_ntz")
    for part in (rows.filter(F.col("ts") < middle), rows.filter(F.col("ts") >= middle)):
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        stream_smooth_table(stream, out, f"{out}-state", f"{out}-checkpoint", block_rows=128).awaitTermination()
    made = spark.read.parquet(out).filter(~F.col("late")).withColumnRenamed("value_filt", "filt")
    return rounded(made.select(*KEYS, "filt"), ["filt"])


_BOUNDS = {"temp": (0.0, 150.0), "rh": (0.0, 1000.0), "pressure": (0.0, 1000.0)}


def _streamed(spark, sf_dir):
    landing, root = work_path(spark, "landing"), work_path(spark, "stream")
    rows = hourly(spark, sf_dir, True)
    master = MasterTable(f"{root}/master", SENSORS)
    # An older copy first, then the rows themselves: the second batch corrects the first.
    for part in (rows.withColumns({"ws": F.col("ws") + 1}), rows):
        _append(part, landing)
        run = stream_ingest(
            spark, landing, master, f"{root}/checkpoint", f"{root}/rejected", _BOUNDS, interval=None
        )
        run.awaitTermination()
    return master, f"{root}/rejected"


def _append(df, path):
    cells = df.select("station", *[F.col(c).cast("string").alias(n) for c, n in _NAMES.items()])
    cells.write.mode("append").option("header", True).csv(path)


@query(f"{CLEAN_ROWS} WHERE temp <= 150")
def stream_ingest_rows(spark, sf_dir):
    master, _ = _streamed(spark, sf_dir)
    return _clean(master.read(spark))


@query(
    f"""WITH {CLEAN_SQL}, v AS (SELECT station, "timestamp", 'temp=' || CAST(temp AS VARCHAR) || ' above max 150.0' AS violations
 FROM c WHERE temp > 150) SELECT station, "timestamp", count(*) AS times FROM v GROUP BY ALL"""
)
def stream_quarantine(spark, sf_dir):
    _, rejected = _streamed(spark, sf_dir)
    return spark.read.parquet(rejected).groupBy("station", "timestamp").agg(F.countDistinct("violations").alias("times"))


@query(KALMAN_ROWS)
def stream_smooth(spark, sf_dir):
    """Smoothing with carried state over three arrivals equals the batch result."""
    landing, out = work_path(spark, "landing"), work_path(spark, "smoothed")
    rows = readings(spark, sf_dir)
    edges = rows.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    step = (edges["high"] - edges["low"]) / 3
    for i in range(3):
        low, high = edges["low"] + i * step, edges["low"] + (i + 1) * step
        part = rows.filter((F.col("ts") >= F.lit(low).cast("timestamp_ntz")) if i else F.lit(True))
        part = part.filter((F.col("ts") < F.lit(high).cast("timestamp_ntz")) if i < 2 else F.lit(True))
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        run = (
            smooth_stream(stream)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", f"{out}-checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    made = spark.read.parquet(out).filter(~F.col("late")).withColumnRenamed("value_filt", "filt")
    return rounded(made.select(*KEYS, "filt"), ["filt"])


ZSCORE_ALERTS_SQL = f"""WITH {READINGS_SQL}, z AS (SELECT *, CAST(coalesce(abs((value - avg(value) OVER w) / stddev_samp(value) OVER w) > 2.0,
 false) AS INTEGER) AS flagged FROM r WINDOW w AS (PARTITION BY station, sensor))
SELECT station, count(*) AS total_records, CAST(sum(flagged) AS BIGINT) AS anomaly_count,
 round(100.0 * sum(flagged) / count(*), 2) AS anomaly_pct FROM z GROUP BY station HAVING sum(flagged) >= 1"""


@query(ZSCORE_ALERTS_SQL)
def stream_alert_rows(spark, sf_dir):
    landing, out = work_path(spark, "flagged"), work_path(spark, "alerts")
    df, spec = indexed(spark, sf_dir)
    flagged = zscore_flags(df, spec, {"anomaly_combined": ["value"]}, 2.0)
    flagged.write.parquet(landing)
    stream = spark.readStream.schema(flagged.schema).parquet(landing)
    stream_alerts(stream, ["station"], ["ts", "seq"], out, f"{out}-checkpoint").awaitTermination()
    found = spark.read.parquet(out)
    return found.select("station", "total_records", "anomaly_count", "anomaly_pct")


@query(ZSCORE_ALERTS_SQL)
def alert_counts(spark, sf_dir):
    df, spec = indexed(spark, sf_dir)
    return alert_summary(zscore_flags(df, spec, {"anomaly_combined": ["value"]}, 2.0), ["station"])
