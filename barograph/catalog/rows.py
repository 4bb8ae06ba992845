"""Queries on rows: types, fills, bounds, keys, sets, projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from barograph.catalog.inputs import (
    INDEXED_SQL,
    RAW_SENSORS,
    RAW_SQL,
    READINGS_SQL,
    TYPED_SQL,
    hourly,
    hourly_sql,
    indexed,
    raw_batch,
    readings,
    rounded,
    rounded_sql,
)
from barograph.catalog.registry import query
from barograph.functions.columns import capped_period, capped_season, hour_of
from barograph.operators.features import composite_ratios
from barograph.operators.normalize import (
    canonical_headers,
    coerce_types,
    drop_incomplete,
    fill_rules,
    keep_last,
    normalize,
    select_sensors,
)
from barograph.operators.validate import check_bounds, quarantine_rows as keep_rejected, valid_rows as keep_valid
from barograph.plans.layout import series_sizes
from barograph.sources.master import count_new_keys
from barograph.sources.sinks import schema_hash, stale_models as find_stale

TYPED = ", ".join(["station", "seq", '"timestamp"', *RAW_SENSORS])
FILLED_SQL = f"""{TYPED_SQL},
f AS (SELECT station, seq, "timestamp", temp, rh, pressure, coalesce(ws, 0.0) AS ws,
             coalesce(dew, temp - 5.0) AS dew FROM t)"""
REQUIRED_SQL = f"""{FILLED_SQL},
q AS (SELECT * FROM f WHERE "timestamp" IS NOT NULL AND temp IS NOT NULL AND rh IS NOT NULL AND pressure IS NOT NULL)"""


@query(f"WITH {TYPED_SQL} SELECT {TYPED} FROM t")
def coerce_cells(spark, sf_dir):
    return coerce_types(raw_batch(spark, sf_dir), RAW_SENSORS)


@query(f'WITH {FILLED_SQL} SELECT station, seq, "timestamp", temp, rh, pressure, ws, {rounded_sql("dew", "dew")} FROM f')
def fill_missing(spark, sf_dir):
    return rounded(fill_rules(coerce_types(raw_batch(spark, sf_dir), RAW_SENSORS)), ["dew"])


@query(f'WITH {REQUIRED_SQL} SELECT station, seq, "timestamp", temp, rh, pressure, ws, {rounded_sql("dew", "dew")} FROM q')
def required_filter(spark, sf_dir):
    return rounded(drop_incomplete(fill_rules(coerce_types(raw_batch(spark, sf_dir), RAW_SENSORS))), ["dew"])


@query(
    f"""WITH {REQUIRED_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY station, "timestamp" ORDER BY seq DESC) AS rn FROM q)
SELECT station, "timestamp", temp, rh, pressure, ws, {rounded_sql("dew", "dew")}, seq FROM k WHERE rn = 1"""
)
def normalize_batch(spark, sf_dir):
    clean = normalize(raw_batch(spark, sf_dir), RAW_SENSORS, ("station", "timestamp"), ("seq",))
    return rounded(clean, ["dew"])


@query(
    f"""WITH {RAW_SQL} SELECT seq, "timestamp", coalesce(temp, dew) AS temp, rh, pressure, ws, dew AS wind_gust_max FROM b"""
)
def rename_headers(spark, sf_dir):
    b = raw_batch(spark, sf_dir)
    messy = b.select("seq", "timestamp", "temp", "rh", "pressure", "ws", F.col("dew"), F.col("dew").alias("gust"))
    headers = ["seq", " Date  Time ", "Temperature", "Relative  Humidity", "PRESSURE_MSL", "wind  speed", "temp", "Wind Gust  Max"]
    return canonical_headers(messy, headers)


@query(
    f"""WITH {RAW_SQL} SELECT "timestamp", CAST(NULL AS DOUBLE) AS rain, temp, CAST(NULL AS DOUBLE) AS wd, seq FROM b"""
)
def project_sensors(spark, sf_dir):
    return select_sensors(raw_batch(spark, sf_dir), ("rain", "temp", "wd"), ("seq", "absent"))


_BOUNDS = {"temp": (0.5, 150.0), "rh": (0.0, 100.0), "pressure": (1.0, 200.0)}


def _check_sql(name: str, low: float, high: float) -> str:
    return f"""CASE WHEN {name} IS NULL THEN '{name}: missing value'
  WHEN {name} < {low} THEN '{name}=' || CAST({name} AS VARCHAR) || ' below min {low}'
  WHEN {name} > {high} THEN '{name}=' || CAST({name} AS VARCHAR) || ' above max {high}' END"""


CHECKED_SQL = f"""{TYPED_SQL},
c AS (SELECT *, concat_ws('; ', {", ".join(_check_sql(k, *v) for k, v in _BOUNDS.items())},
  CASE WHEN ws IS NULL THEN 'ws: missing value' END, CASE WHEN dew IS NULL THEN 'dew: missing value' END) AS violations FROM t)"""


def _checked(spark, sf_dir):
    return check_bounds(coerce_types(raw_batch(spark, sf_dir), RAW_SENSORS), _BOUNDS, RAW_SENSORS)


def _joined(df):
    return df.withColumn("violations", F.concat_ws("; ", "violations"))


@query(f"WITH {CHECKED_SQL} SELECT station, seq, violations FROM c")
def bounds_violations(spark, sf_dir):
    return _joined(_checked(spark, sf_dir)).select("station", "seq", "violations")


@query(f"WITH {CHECKED_SQL} SELECT {TYPED} FROM c WHERE violations = ''")
def valid_rows(spark, sf_dir):
    return keep_valid(_checked(spark, sf_dir))


@query(f"WITH {CHECKED_SQL} SELECT {TYPED}, violations FROM c WHERE violations <> ''")
def quarantine_rows(spark, sf_dir):
    return _joined(keep_rejected(_checked(spark, sf_dir)))


def _hour_keyed(df):
    return df.withColumn("hour", hour_of("ts"))


@query(
    f"""WITH {READINGS_SQL}, k AS (SELECT *, date_trunc('hour', ts) AS hour, row_number() OVER
 (PARTITION BY station, sensor, date_trunc('hour', ts) ORDER BY ts DESC, seq DESC) AS rn FROM r)
SELECT station, sensor, hour, seq, value FROM k WHERE rn = 1"""
)
def dedupe_keep_last(spark, sf_dir):
    last = keep_last(_hour_keyed(readings(spark, sf_dir)), ("station", "sensor", "hour"), ("ts", "seq"))
    return last.select("station", "sensor", "hour", "seq", "value")


@query(
    f"""WITH {READINGS_SQL} SELECT station, sensor, ts, seq, value, CAST(NULL AS DOUBLE) AS half FROM r
UNION ALL SELECT station, sensor, ts, seq, NULL, value / 2 FROM r"""
)
def union_batches(spark, sf_dir):
    r = readings(spark, sf_dir)
    second = r.select("station", "sensor", "ts", "seq", (F.col("value") / 2).alias("half"))
    return r.unionByName(second, allowMissingColumns=True)


SHIFTED_SQL = f"""{READINGS_SQL},
e AS (SELECT station, sensor, date_trunc('hour', ts) AS hour, 0 AS batch, ts, seq, value FROM r),
i AS (SELECT station, sensor, date_trunc('hour', ts + INTERVAL 10 DAY) AS hour, 1 AS batch, ts, seq, value * 2 AS value FROM r)"""


def _existing_and_incoming(spark, sf_dir):
    r = readings(spark, sf_dir)
    later = r.withColumn("ts", F.expr("ts + INTERVAL 10 DAY")).withColumn("value", F.col("value") * 2)
    return _hour_keyed(r), _hour_keyed(later)


@query(
    f"""WITH {SHIFTED_SQL}, u AS (SELECT * FROM e UNION ALL SELECT * FROM i),
k AS (SELECT *, row_number() OVER (PARTITION BY station, sensor, hour ORDER BY batch DESC, ts DESC, seq DESC) AS rn FROM u)
SELECT station, sensor, hour, value FROM k WHERE rn = 1"""
)
def upsert_rows(spark, sf_dir):
    existing, incoming = _existing_and_incoming(spark, sf_dir)
    both = existing.withColumn("batch", F.lit(0)).unionByName(incoming.withColumn("batch", F.lit(1)))
    merged = keep_last(both, ("station", "sensor", "hour"), ("batch", "ts", "seq"))
    return merged.select("station", "sensor", "hour", "value")


@query(
    f"""WITH {SHIFTED_SQL}, ke AS (SELECT DISTINCT station, sensor, hour FROM e), ki AS (SELECT DISTINCT station, sensor, hour FROM i),
f AS (SELECT count(*) AS fresh FROM ki ANTI JOIN ke USING (station, sensor, hour))
SELECT CAST(fresh AS BIGINT) AS new_records, CAST(fresh + (SELECT count(*) FROM ke) AS BIGINT) AS total_records FROM f"""
)
def new_record_count(spark, sf_dir):
    existing, incoming = _existing_and_incoming(spark, sf_dir)
    return count_new_keys(incoming, existing, ("station", "sensor", "hour"))


@query(
    f"""WITH {hourly_sql()} SELECT station, "timestamp", {rounded_sql('temp / (rh + 1e-6)', 'temp_rh_ratio')},
 {rounded_sql('pressure * temp', 'pressure_temp_product', 1)} FROM h"""
)
def sensor_ratios(spark, sf_dir):
    made = composite_ratios(hourly(spark, sf_dir))
    made = made.select("station", "timestamp", "temp_rh_ratio", "pressure_temp_product")
    return rounded(rounded(made, ["temp_rh_ratio"]), ["pressure_temp_product"], 1)


@query(
    f"""WITH {hourly_sql(True)} SELECT "timestamp", {rounded_sql('temp', '"Temperature"')}, {rounded_sql('pressure', '"Pressure"')},
 {rounded_sql('rh', '"Humidity"')} FROM h"""
)
def select_rename(spark, sf_dir):
    names = {"temp": "Temperature", "pressure": "Pressure", "rh": "Humidity"}
    picked = hourly(spark, sf_dir, True).select("timestamp", *names).withColumnsRenamed(names)
    return rounded(picked, names.values())


@query(
    f"""WITH {INDEXED_SQL}, c AS (SELECT DISTINCT station, sensor, n FROM p) SELECT station, sensor, n,
 CAST(CASE WHEN n < 8 THEN 2 ELSE least(1440, greatest(2, n // 3)) END AS BIGINT) AS period,
 CAST(CASE WHEN n < 44 THEN 2 ELSE least(60, greatest(2, n // 24)) END AS BIGINT) AS season FROM c"""
)
def capped_periods(spark, sf_dir):
    sizes = series_sizes(readings(spark, sf_dir), indexed(spark, sf_dir)[1])
    return sizes.withColumns({"period": capped_period(1440, "n"), "season": capped_season(60, "n", 24)})


_SENSOR_LIST, _OLD_LIST = ("temp", "rh"), ("temp", "humidity")


@query(
    f"""WITH {READINGS_SQL}, s AS (SELECT DISTINCT station, sensor FROM r),
m AS (SELECT station, sensor, CASE WHEN sensor = 'click' THEN sha256('temp|humidity|temp') ELSE sha256('temp|rh|temp') END AS hash
 FROM s WHERE sensor <> 'error')
SELECT s.station, s.sensor FROM s LEFT JOIN m USING (station, sensor) WHERE m.hash IS NULL OR m.hash <> sha256('temp|rh|temp')"""
)
def stale_models(spark, sf_dir):
    r = readings(spark, sf_dir)
    wanted = schema_hash(_SENSOR_LIST, "temp")
    fitted = F.when(F.col("sensor") == "click", schema_hash(_OLD_LIST, "temp")).otherwise(wanted)
    models = r.select("station", "sensor").distinct().filter("sensor <> 'error'").withColumn("schema_hash", fitted)
    return find_stale(models, r, ("station", "sensor"), wanted)
