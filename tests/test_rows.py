"""Headers, types, fills, keys and bounds."""

import datetime as dt

from pyspark.sql import functions as F

from barograph.functions.columns import hour_of, to_number, to_time
from barograph.operators.normalize import canonical_headers, data_columns, header_name, keep_last, normalize
from barograph.operators.validate import check_bounds, split_valid


def test_header_names():
    assert header_name("﻿DateTime") == "timestamp"
    assert header_name("  Relative  Humidity ") == "rh"
    assert header_name("Wind Gust  Max") == "wind_gust_max"
    assert header_name("temperature_2m") == "temp"


def test_two_headers_for_one_name_are_coalesced(spark):
    df = spark.createDataFrame([("1", None), (None, "2"), ("3", "4")], "temp string, Temperature string")
    assert [r.temp for r in canonical_headers(df).collect()] == ["1", "2", "3"]


def test_numbers_and_times(spark):
    cells = [" 1.5 ", "1e3", "-.5", "nan", "NaN", "", "x", "1.5d", "0x1p3", "inf", None]
    got = spark.createDataFrame([(c,) for c in cells], "c string").select(to_number("c").alias("v")).collect()
    assert [r.v for r in got] == [1.5, 1000.0, -0.5, None, None, None, None, None, None, float("inf"), None]
    times = ["2025-01-02 03:04:05", "2025-01-02T03:04:05", "1/2/2025 3:04", "2025/01/02 03:04:05", "32/13/2025", ""]
    got = spark.createDataFrame([(t,) for t in times], "c string").select(to_time("c").alias("v")).collect()
    full = dt.datetime(2025, 1, 2, 3, 4, 5)
    assert [r.v for r in got] == [full, full, full.replace(second=0), full, None, None]


def test_hour_keeps_the_zoneless_type(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2025-03-30 02:59:59.9' AS ts").select(hour_of("ts").alias("h"))
    assert df.dtypes == [("h", "timestamp_ntz")]
    assert df.first().h == dt.datetime(2025, 3, 30, 2)


RAW = [
    ("2025-01-01 00:00:00", "20", "50", "1000", None, 1),
    ("2025-01-01 00:00:00", "21", "51", "1001", "3", 2),
    ("2025-01-01 00:01:00", "bad", "50", "1000", None, 3),
    ("no time", "20", "50", "1000", None, 4),
    ("2025-01-01 00:02:00", "22", "150", "500", None, 5),
]


def raw(spark):
    return spark.createDataFrame(RAW, "DateTime string, Temperature string, Humidity string, Pressure string, WS string, seq int")


def test_normalize_fills_filters_and_keeps_the_last(spark):
    rows = {r.timestamp.minute: r for r in normalize(raw(spark)).collect()}
    assert sorted(rows) == [0, 2]
    assert (rows[0].temp, rows[0].ws, rows[0].dew, rows[0].rain) == (21.0, 3.0, 16.0, 0.0)
    assert (rows[2].ws, rows[2].wd, rows[2].dew) == (0.0, 0.0, 17.0)


def test_normalize_is_idempotent(spark):
    once = normalize(raw(spark))
    again = normalize(once)
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))


def test_no_timestamp_gives_no_rows(spark):
    df = spark.createDataFrame([("20", 1)], "temp string, seq int")
    assert normalize(df).count() == 0


def test_keep_last_with_very_many_copies_of_one_key(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 15_000, 0).otherwise(F.col("id")).alias("k"), "id")
    last = keep_last(df, ["k"], ["id"])
    assert last.count() == 5_001
    assert last.filter("k = 0").first().id == 14_999


def test_keep_last_takes_whole_rows_with_nulls_and_ties(spark):
    rows = [(1, 1, 1.0, None), (1, 2, None, 5.0), (2, None, 3.0, 4.0), (3, 7, 1.0, 1.0), (3, 7, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "k long, seq long, a double, b double")
    hashed = {r.k: (r.seq, r.a, r.b) for r in keep_last(df, ["k"], ["seq"]).collect()}
    texts = df.withColumn("note", F.lit("x"))
    ranked = {r.k: (r.seq, r.a, r.b) for r in keep_last(texts, ["k"], ["seq"]).collect()}
    assert hashed[1] == ranked[1] == (2, None, 5.0)
    assert hashed[2] == ranked[2] == (None, 3.0, 4.0)
    assert hashed[3] in ((7, 1.0, 1.0), (7, 2.0, 2.0))


def test_violations_and_known_rows(spark):
    clean = normalize(raw(spark))
    valid, rejected = split_valid(clean)
    assert valid.count() == 1
    assert rejected.first().violations == ["pressure=500.0 below min 800.0", "rh=150.0 above max 100.0"]
    hot = spark.createDataFrame([(70.0, 65.0)], "temp double, dew double")
    assert check_bounds(hot).first().violations == ["temp=70.0 above max 55.0", "dew=65.0 above max 50.0"]


def test_bounds_are_inclusive_and_nulls_are_reported(spark):
    df = spark.createDataFrame([(55.0, 1.0), (-40.0, None), (None, 2.0)], "temp double, extra double")
    got = [r.violations for r in check_bounds(df, sensors=("temp", "extra")).collect()]
    assert got == [[], ["extra: missing value"], ["temp: missing value"]]


def test_text_columns_report_an_invalid_value(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,), ("99",)], "temp string")
    got = [r.violations for r in check_bounds(df).collect()]
    assert got == [[], ["temp: invalid type/value"], ["temp: missing value"], ["temp=99.0 above max 55.0"]]


def test_valid_and_rejected_make_up_the_input(spark):
    df = spark.range(200).select((F.col("id") - 60).cast("double").alias("temp"))
    valid, rejected = split_valid(df)
    assert valid.count() + rejected.count() == 200
    assert valid.agg(F.min("temp"), F.max("temp")).first()[:] == (-40.0, 55.0)


def test_data_columns_prefer_the_smoothed_one(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "temp double, temp_filt double, rh double")
    assert data_columns(df) == {"rh": "rh", "temp": "temp_filt"}
