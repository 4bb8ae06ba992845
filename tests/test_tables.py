"""Files, master table, sinks, streams and the whole run."""

import datetime as dt
import os
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from conftest import ordered, same
from test_series import brute_kalman

from pyspark.sql import functions as F

from barograph.params import DriftParams, ForecastParams, RunParams, SeasonalParams, SeriesSpec
from barograph.plans.layout import index_series
from barograph.plans.job import drifted_stations, run_job
from barograph.plans.run import run_stations
from barograph.sources.csvfiles import read_delimited, scan_readings
from barograph.sources.master import MasterTable, count_new_keys, ingest
from barograph.sources.sinks import append_run_metrics, schema_hash, stale_models, write_results
from barograph.streaming.ingest import stream_ingest
from barograph.streaming.smooth import stream_smooth, stream_smooth_table

SENSORS = ("rh", "temp", "pressure")


def write(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding=encoding) as f:
        f.write(text)


def test_files_with_other_headers_are_merged_in_name_order(spark, folder):
    write(folder, "a.csv", "timestamp,temperature,humidity,pressure\n2025-01-01 00:00:00,1,2,900\n2025-01-01 00:01:00,3,4,900\n")
    write(folder, "b.csv", "DateTime,WS,Pressure,RH,Temp,Note\n2025-01-01 00:01:00,7,901,5,6,x\n2025-01-01 00:01:00,,902,7,8,y\n")
    write(folder, "c.txt", "DateTime,Temp\n2025-01-01 00:05:00,1\n")
    write(folder, "d.csv", "")
    rows = {r.timestamp.minute: r for r in scan_readings(spark, folder).collect()}
    assert sorted(rows) == [0, 1]
    assert (rows[0].temp, rows[0].rh, rows[0].dew, rows[0].ws) == (1.0, 2.0, -4.0, 0.0)
    assert (rows[1].temp, rows[1].rh, rows[1].pressure, rows[1].ws) == (8.0, 7.0, 902.0, 0.0)


def test_tab_separated_with_mark_and_bad_bytes(spark, folder):
    write(folder, "a.csv", "DateTime\tTemp\tRH\tPressure\n2025-01-01 00:00:00\t1.5\t2\t900\n", "utf-8-sig")
    with open(os.path.join(folder, "a.csv"), "ab") as f:
        f.write(b"2025-01-01 00:01:00\t\xff\xfe\t2\t900\n")
    rows = scan_readings(spark, folder, SENSORS).collect()
    assert [(r.timestamp, r.temp) for r in rows] == [(dt.datetime(2025, 1, 1), 1.5)]


def test_headers_of_many_files_do_not_come_to_the_driver_one_by_one(spark, folder):
    """Files with two kinds of headers, two columns for one name, quotes, blank lines and a repeated header."""
    for i in range(4):
        write(folder, f"a{i}.csv", f'timestamp,temp,rh,pressure\n\n2025-01-01 0{i}:00:00,"{i}",2,900\ntimestamp,temp,rh,pressure\n')
        write(folder, f"b{i}.csv", f"\npressure\ttemp\ttemperature\thumidity\ttime\n901\t\t{i}\t5\t2025-01-02 0{i}:00:00\n")
    lines = read_delimited(spark, folder)
    assert set(lines.columns) >= {"timestamp", "temp", "rh", "pressure"}
    assert lines._jdf.queryExecution().executedPlan().toString().count("FileScan text") <= 2
    got = {(r.timestamp.day, r.timestamp.hour): (r.temp, r.rh, r.pressure) for r in scan_readings(spark, folder, SENSORS).collect()}
    assert got == {(1, i): (float(i), 2.0, 900.0) for i in range(4)} | {(2, i): (float(i), 5.0, 901.0) for i in range(4)}


def test_missing_and_empty_folders_give_an_empty_typed_frame(spark, folder):
    for path in (f"{folder}/missing", folder):
        got = scan_readings(spark, path, SENSORS)
        assert got.count() == 0
        assert dict(got.dtypes)["timestamp"] == "timestamp_ntz"


def frame(spark, rows):
    rows = [(s, dt.datetime(2025, 1, 1) + dt.timedelta(hours=h), float(v), 1.0, 900.0) for s, h, v in rows]
    return spark.createDataFrame(rows, "station string, timestamp timestamp_ntz, rh double, temp double, pressure double")


def values(df):
    return {(r.station, (r.timestamp - dt.datetime(2025, 1, 1)).total_seconds() / 3600): r.rh for r in df.collect()}


def test_master_upsert_replace_and_compact(spark, folder):
    master = MasterTable(folder, SENSORS)
    assert master.read(spark).count() == 0
    assert master.upsert(frame(spark, [])) == 0
    assert master.upsert(frame(spark, [("a", 0, 1), ("a", 30, 2)])) == 2
    assert master.upsert(frame(spark, [("a", 30, 3), ("b", 0, 4)])) == 1
    want = {("a", 0): 1.0, ("a", 30): 3.0, ("b", 0): 4.0}
    assert values(master.read(spark)) == want
    assert master.compact(spark) == 3
    assert values(master.read(spark)) == want
    assert master.replace(frame(spark, [])) == 0
    assert values(master.read(spark)) == want
    assert master.replace(frame(spark, [("c", 1, 9)])) == 1
    assert values(master.read(spark)) == {("c", 1): 9.0}
    ledger = [(r.new_rows, r.total_rows) for r in master.commits(spark).orderBy("epoch", "batch").collect()]
    assert ledger == [(2, 2), (1, 3), (3, 3), (1, 1)]


def test_a_repeated_or_unfinished_batch_changes_nothing(spark, folder):
    master = MasterTable(folder, SENSORS)
    master.upsert(frame(spark, [("a", 0, 1)]), "s", 0)
    assert master.upsert(frame(spark, [("a", 0, 7)]), "s", 0) == 0
    master._write(frame(spark, [("z", 0, 7)]))  # written, never committed
    assert values(master.read(spark)) == {("a", 0): 1.0}
    master.upsert(frame(spark, [("a", 1, 2)]), "s", 1)
    assert values(master.read(spark)) == {("a", 0): 1.0, ("a", 1): 2.0}


class Interrupted(MasterTable):
    """Another writer does something between this one's look at the ledger and its commit, once."""

    def meanwhile(self, act):
        object.__setattr__(self, "_act", act)
        return self

    def state(self, spark):
        found, act = super().state(spark), self.__dict__.pop("_act", None)
        if act:
            act(MasterTable(self.root, self.sensors))
        return found


def test_two_writers_keep_both_batches(spark, folder):
    master = MasterTable(folder, SENSORS)
    assert Interrupted(folder, SENSORS).meanwhile(lambda m: m.upsert(frame(spark, [("a", 0, 1), ("a", 30, 1)]))).upsert(
        frame(spark, [("a", 0, 2), ("b", 1, 3)])
    ) == 1
    assert values(master.read(spark)) == {("a", 0): 2.0, ("a", 30): 1.0, ("b", 1): 3.0}
    assert [(r.new_rows, r.total_rows) for r in master.commits(spark).orderBy("number").collect()] == [(2, 2), (1, 3)]
    batch = frame(spark, [("c", 0, 5)])
    assert Interrupted(folder, SENSORS).meanwhile(lambda m: m.upsert(batch, "s", 4)).upsert(batch, "s", 4) == 0
    assert master.total(spark) == 4


@pytest.mark.parametrize("act,want", [
    ("compact", {("a", 0): 1.0, ("a", 30): 9.0, ("b", 0): 8.0}),
    ("replace", {("a", 30): 9.0, ("b", 0): 8.0, ("z", 0): 7.0}),
])
def test_a_snapshot_during_an_upsert_loses_no_row(spark, folder, act, want):
    """An upsert whose epoch is over before it commits is counted again and committed on the new one."""
    master = MasterTable(folder, SENSORS)
    master.upsert(frame(spark, [("a", 0, 1), ("a", 30, 2)]))

    def other(m):
        m.compact(spark) if act == "compact" else m.replace(frame(spark, [("z", 0, 7)]))

    assert Interrupted(folder, SENSORS).meanwhile(other).upsert(frame(spark, [("a", 30, 9), ("b", 0, 8)])) == len(want) - (
        2 if act == "compact" else 1
    )
    assert values(master.read(spark)) == want
    assert master.total(spark) == len(want)


def test_an_upsert_during_a_compaction_or_a_snapshot(spark, folder):
    master = MasterTable(folder, SENSORS)
    master.upsert(frame(spark, [("a", 0, 1), ("a", 30, 2)]))
    late = frame(spark, [("a", 30, 9), ("b", 0, 8)])
    assert Interrupted(folder, SENSORS).meanwhile(lambda m: m.upsert(late)).compact(spark) == 2
    want = {("a", 0): 1.0, ("a", 30): 9.0, ("b", 0): 8.0}
    assert values(master.read(spark)) == want and master.total(spark) == 3
    assert master.upsert(frame(spark, [("b", 0, 5), ("c", 0, 5)])) == 1
    assert master.compact(spark) == 4
    # A snapshot during a compaction stays: the compaction starts again from it.
    snapshot = frame(spark, [("z", 0, 7)])
    assert Interrupted(folder, SENSORS).meanwhile(lambda m: m.replace(snapshot)).compact(spark) == 1
    assert values(master.read(spark)) == {("z", 0): 7.0}
    # A replacement that comes second replaces what was committed while it was written.
    assert Interrupted(folder, SENSORS).meanwhile(lambda m: m.upsert(late)).replace(frame(spark, [("y", 0, 6)])) == 1
    assert values(master.read(spark)) == {("y", 0): 6.0} and master.total(spark) == 1


def test_threads_that_write_at_once_keep_all_rows(spark, folder):
    from concurrent.futures import ThreadPoolExecutor

    master = MasterTable(folder, SENSORS)
    master.upsert(frame(spark, [("a", 0, 0)]))
    with ThreadPoolExecutor(4) as pool:
        jobs = [pool.submit(master.upsert, frame(spark, [("a", 0, i), (f"s{i}", i, i)])) for i in range(1, 5)]
        jobs.append(pool.submit(master.compact, spark))
        [job.result() for job in jobs]
    got = values(master.read(spark))
    assert {k: v for k, v in got.items() if k != ("a", 0)} == {(f"s{i}", i): float(i) for i in range(1, 5)}
    assert master.total(spark) == len(got) == 5


def test_days_of_one_batch_are_read_without_a_shuffle(spark, folder):
    def exchanges(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning"), plan.count("Scan parquet")

    master = MasterTable(folder, SENSORS)
    master.upsert(frame(spark, [("a", h, h) for h in range(0, 240, 5)]))
    assert exchanges(master.read(spark)) == (0, 1)
    master.upsert(frame(spark, [("a", 0, 9), ("a", 1, 9), ("a", 300, 9)]))
    assert exchanges(master.read(spark)) == (1, 2)
    several = master.read(spark).filter(F.col("rh") >= 0)
    files = [f for f in several.inputFiles() if "day=2025-01-01" in f]
    assert len(files) == 2  # only the shared day is read from both batches
    assert values(master.read(spark)) == {("a", h): 9.0 if h == 0 else float(h) for h in range(0, 240, 5)} | {
        ("a", 1): 9.0, ("a", 300): 9.0,
    }


def test_repeated_and_incomplete_keys_in_a_batch(spark, folder):
    master = MasterTable(folder, SENSORS)
    rows = frame(spark, [("a", 0, 1), ("a", 0, 2), ("a", 1, 3)])
    assert master.upsert(rows.union(rows.selectExpr("station", "cast(null as timestamp_ntz)", "rh", "temp", "pressure"))) == 2
    first = values(master.read(spark))
    assert set(first) == {("a", 0), ("a", 1)}
    other = MasterTable(f"{folder}/other", SENSORS)
    other.upsert(rows.repartition(3))
    assert values(other.read(spark)) == first


def test_ingest_prefers_the_snapshot(spark, folder):
    head = "timestamp,temp,rh,pressure\n"
    write(f"{folder}/stream", "a.csv", head + "2025-01-01 00:00:00,1,1,900\n")
    write(f"{folder}/snapshot", "x.csv", head + "2025-01-02 00:00:00,1,2,900\n")
    master = MasterTable(f"{folder}/master", SENSORS)
    assert values(ingest(spark, master, f"{folder}/stream")) == {("0", 0): 1.0}
    merged = ingest(spark, master, f"{folder}/stream", f"{folder}/snapshot", replace_master=False)
    assert values(merged) == {("0", 0): 1.0, ("0", 24): 2.0}
    assert values(ingest(spark, master, f"{folder}/stream", f"{folder}/snapshot")) == {("0", 24): 2.0}
    assert values(ingest(spark, master, f"{folder}/none", f"{folder}/none")) == {("0", 24): 2.0}


def test_new_key_count(spark):
    old, new = spark.range(0, 10), spark.range(5, 12).union(spark.range(5, 12))
    assert count_new_keys(new, old, ["id"]).first()[:] == (2, 12)


def test_sinks(spark, folder):
    df = spark.createDataFrame([("a", 1), ("b", 0)], "station string, anomaly_combined int")
    write_results(df, f"{folder}/out")
    assert spark.read.parquet(f"{folder}/out").count() == 2
    assert append_run_metrics(df, f"{folder}/metrics", 5)["run"] == 1
    assert append_run_metrics(df, f"{folder}/metrics", 0) == {
        "run": 2, "records_total": 2, "anomalies": 1, "new_records_last_run": 0,
    }
    models = df.select("station").filter("station = 'a'").withColumn("schema_hash", schema_hash(["x"], "x"))
    assert [r[0] for r in stale_models(models, df, ["station"], schema_hash(["x"], "x")).collect()] == ["b"]
    assert stale_models(models, df, ["station"], schema_hash(["x", "y"], "x")).count() == 2


def test_stream_ingest_equals_one_batch(spark, folder):
    head = "timestamp,temp,rh,pressure\n"
    landing, master = f"{folder}/landing", MasterTable(f"{folder}/master", SENSORS)

    def run():
        stream_ingest(spark, landing, master, f"{folder}/c", f"{folder}/bad", interval=None).awaitTermination()

    write(landing, "a.csv", head + "2025-01-01 02:00:00,1,1,900\n2025-01-01 03:00:00,1,300,900\n")
    run()
    write(landing, "b.csv", head + "2025-01-01 00:00:00,1,5,900\n2025-01-01 02:00:00,1,6,900\n")
    run()
    run()
    assert values(master.read(spark)) == {("0", 0): 5.0, ("0", 2): 6.0}
    assert spark.read.parquet(f"{folder}/bad").count() == 1


def test_stream_reads_each_file_by_its_header_and_survives_a_new_checkpoint(spark, folder):
    landing, master = f"{folder}/landing", MasterTable(f"{folder}/master", SENSORS)

    def run(checkpoint):
        stream_ingest(spark, landing, master, f"{folder}/{checkpoint}", f"{folder}/bad", interval=None).awaitTermination()

    write(landing, "a.csv", "timestamp,temp,rh,pressure\n2025-01-01 00:00:00,1,2,900\n")
    write(landing, "b.csv", "Pressure,RH,Temp,DateTime,station\n901,50,20,2025-01-01 01:00:00,\n902,51,21,2025-01-01 01:00:00,B\n")
    write(landing, "c.csv", "DateTime\tTemp\tRH\tPressure\n2025-01-01 02:00:00\t3\t4\t903\n")
    run("first")
    write(landing, "d.csv", "timestamp,temp,rh,pressure\n2025-01-01 03:00:00,7,8,904\n2025-01-01 04:00:00,7,300,904\n")
    run("second")
    got = {(r.station, r.timestamp.hour): (r.temp, r.rh, r.pressure) for r in master.read(spark).collect()}
    assert got == {
        ("0", 0): (1.0, 2.0, 900.0), ("0", 1): (20.0, 50.0, 901.0), ("B", 1): (21.0, 51.0, 902.0),
        ("0", 2): (3.0, 4.0, 903.0), ("0", 3): (7.0, 8.0, 904.0),
    }
    assert spark.read.parquet(f"{folder}/bad").count() == 1


def test_stream_smooth_equals_batch_and_sets_late_rows_aside(spark, folder):
    rng = np.random.default_rng(4)
    x = rng.normal(10, 2, 60)
    pdf = pd.DataFrame({"station": 1, "sensor": "a", "seq": range(60), "value": x})
    pdf["ts"] = pd.date_range("2025-01-01", periods=60, freq="1min")
    schema = "station long, sensor string, ts timestamp_ntz, seq long, value double"
    parts = [pdf[:20], pd.concat([pdf[35:], pdf[20:35], pdf[5:8]])]
    for part in parts:
        rows = [(int(r.station), r.sensor, r.ts.to_pydatetime(), int(r.seq), float(r.value)) for r in part.itertuples()]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        writer = stream_smooth(stream).writeStream.option("checkpointLocation", f"{folder}/c")
        writer.option("path", f"{folder}/out").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{folder}/out").toPandas().sort_values("seq")
    same(out[~out.late]["value_filt"], brute_kalman(x), 1e-9)
    assert out[out.late]["seq"].tolist() == [5, 6, 7]


@pytest.mark.parametrize("block", [1_000_000, 16])
def test_table_stream_smooth_equals_batch(spark, folder, block):
    """Arrivals of any size, a series that comes and goes, gaps, late rows and rows before the first value."""
    rng = np.random.default_rng(5)
    series = {(1, "a"): rng.normal(10, 2, 150), (2, "b"): rng.normal(5, 1, 40), (3, "c"): np.full(30, np.nan)}
    series[1, "a"][[3, 70, 71]] = np.nan
    series[2, "b"][:4] = np.nan
    start = pd.Timestamp("2025-01-01")
    rows = [
        (k[0], k[1], (start + pd.Timedelta(minutes=i)).to_pydatetime(), i, None if v != v else float(v))
        for k, x in series.items() for i, v in enumerate(x)
    ]
    schema = "station long, sensor string, ts timestamp_ntz, seq long, value double"
    late = [r for r in rows if r[1] == "a" and r[3] in (5, 6)]
    arrivals = [rows[:2], [r for r in rows[2:] if r[3] < 30], [r for r in rows if 30 <= r[3] < 33 and r[1] == "a"] + late]
    arrivals.append([r for r in rows if r[3] >= 33 or (r[3] >= 30 and r[1] != "a")])
    for part in arrivals:
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        stream_smooth_table(stream, f"{folder}/out", f"{folder}/state", f"{folder}/c", block_rows=block).awaitTermination()
    out = spark.read.parquet(f"{folder}/out").toPandas().sort_values(["sensor", "seq"])
    assert out[out.late]["seq"].tolist() == [5, 6]
    kept = out[~out.late]
    filled = pd.Series(series[1, "a"]).ffill().to_numpy()
    same(kept[kept.sensor == "a"]["value_filt"], brute_kalman(filled), 1e-9)
    b = kept[kept.sensor == "b"]["value_filt"].to_numpy()
    same(b, np.concatenate((np.full(4, np.nan), brute_kalman(series[2, "b"][4:]))), 1e-9)
    assert kept[kept.sensor == "c"]["value_filt"].isna().all() and len(kept) == 220
    assert sorted(os.listdir(f"{folder}/state")) == ["batch=2", "batch=3"]


def station_frame(spark, n=420):
    rng, t = np.random.default_rng(8), np.arange(n)
    pdf = pd.DataFrame({"timestamp": pd.date_range("2025-01-01", periods=n, freq="1min")})
    pdf["rh"], pdf["pressure"] = rng.normal(45, 3, n), rng.normal(980, 5, n)
    pdf["temp"] = 25 + 4 * np.sin(2 * np.pi * t / 30) + rng.normal(0, 0.3, n)
    pdf.loc[100:108, "temp"], pdf.loc[200, "rh"] = 50.0, 110.0
    frames = [pdf.assign(station="a"), pdf.assign(station="b", temp=pdf["temp"] - np.where(t > 250, 8, 0))]
    rows = [
        (r.station, r.timestamp.to_pydatetime(), float(r.rh), float(r.temp), float(r.pressure))
        for r in pd.concat(frames).itertuples()
    ]
    return spark.createDataFrame(rows, "station string, timestamp timestamp_ntz, rh double, temp double, pressure double")


@pytest.fixture(scope="module")
def runs(spark):
    params = RunParams(sensors=SENSORS, seasonal=SeasonalParams(30))
    df = station_frame(spark)
    made = [run_stations(df, params), run_stations(df, RunParams(sensors=SENSORS, seasonal=SeasonalParams(30), block_rows=100))]
    return [(r, ordered(r.results, ("station", "timestamp"))) for r in made]


def test_run_has_every_column_and_row(runs):
    run, results = runs[0]
    groups = 2 + 3 + 3 + 18 + 2 + 9 + 3 + 3 + 6
    assert len(results.columns) == groups
    assert run.rejected.count() == 2
    # 419 valid rows per station, the first six have no full window.
    assert results.groupby("station").size().tolist() == [413, 413]
    parts = results["temp_trend"] + results["temp_seasonal"] + results["temp_residual"]
    same(parts, results["temp_filt"], 1e-8)
    for flag in ("iforest", "zscore", "residual", "forecast_error"):
        assert (results[f"anomaly_{flag}"] <= results["anomaly_combined"]).all()
    # The median removes a single spike; a plateau of nine rows comes through.
    spike = results[results.station == "a"].iloc[95:115]
    assert spike["anomaly_combined"].max() == 1
    assert run.drift.filter("station = 'b' AND sensor = 'temp_filt' AND drift = 1").count() == 1


def test_run_does_not_depend_on_blocks(runs):
    one, other = runs[0][1], runs[1][1]
    for c in one.columns:
        if one[c].dtype.kind == "f":
            same(one[c], other[c], 1e-6)
        else:
            assert (one[c] == other[c]).all(), c


def test_run_of_nothing_is_empty(spark):
    run = run_stations(station_frame(spark).limit(0), RunParams(sensors=SENSORS))
    assert run.results.count() == 0 and run.rejected.count() == 0 and run.drift.count() == 0


def test_index_of_an_empty_frame(spark):
    df = station_frame(spark).limit(0)
    indexed, spec = index_series(df, SeriesSpec(("station",), ("timestamp",)))
    assert indexed.count() == 0 and spec.longest == 0


def test_job_writes_every_table_and_keeps_each_model_until_its_series_drifts(spark, folder):
    params = RunParams(
        sensors=SENSORS,
        seasonal=SeasonalParams(30),
        forecast=ForecastParams(lookback=12, tail_rows=100, use_sarima=False),
        drift=DriftParams(p_threshold=0.0),
    )

    def fits():
        rows = spark.read.parquet(f"{folder}/job/models").collect()
        return {run: {(r.station, r.sensor) for r in rows if r.run == run} for run in {r.run for r in rows}}

    cells = station_frame(spark).select("station", F.col("timestamp").cast("string"), *SENSORS)
    cells.write.option("header", True).csv(f"{folder}/landing")
    run, metrics = run_job(spark, f"{folder}/job", f"{folder}/landing", params=params)
    assert metrics["run"] == 1 and metrics["new_records_last_run"] == 840
    assert metrics["records_total"] == run.results.count()
    assert run.results.filter("forecast_temp IS NOT NULL").count() == 200
    _, again = run_job(spark, f"{folder}/job", f"{folder}/landing", params=params, refresh=False)
    assert again == metrics | {"run": 2, "new_records_last_run": 0}
    every = {(s, c) for s in "ab" for c in SENSORS}
    assert fits() == {1: every}
    assert spark.read.parquet(f"{folder}/job/results/run=2").count() == metrics["records_total"]
    assert spark.read.parquet(f"{folder}/job/quarantine").groupBy("run").count().count() == 2
    assert spark.read.parquet(f"{folder}/job/alerts/run=1").count() == 2
    chances = sorted({r.p_value for r in run.drift.collect()})
    drifting = replace(params, drift=DriftParams(p_threshold=chances[len(chances) // 2]))
    third, _ = run_job(spark, f"{folder}/job", f"{folder}/landing", params=drifting, refresh=False)
    moved = {(r.station, r.sensor.removesuffix("_filt")) for r in third.drift.filter("drift = 1").collect()}
    assert moved and moved != every
    assert drifted_stations(spark, f"{folder}/job").count() == len({s for s, _ in moved})
    for _ in range(2):  # the next run fits the series that drifted, the one after it none
        run_job(spark, f"{folder}/job", f"{folder}/landing", params=params, refresh=False)
    assert fits() == {1: every, 4: moved}
    other = replace(params, forecast=replace(params.forecast, lookback=6))
    run_job(spark, f"{folder}/job", f"{folder}/landing", params=other, refresh=False)
    assert fits()[6] == every  # models for other lags are stale
    assert run_job(spark, f"{folder}/other", f"{folder}/nothing", params=params)[1] == {}
