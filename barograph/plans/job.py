"""One scheduled run: ingest, compute, write all tables, keep each series' model until it drifts."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.drift import drift_flags
from barograph.operators.report import alerts, metric_columns
from barograph.params import RunParams
from barograph.plans.run import StationRun, run_stations
from barograph.session import materialize
from barograph.sources.master import MasterTable, ingest
from barograph.sources.models import EVENTS, ModelTable
from barograph.sources.sinks import append_quarantine, append_run_metrics, table_or_none, write_results


@dataclass(frozen=True)
class JobPaths:
    """Tables of a job below one root."""

    root: str

    def at(self, table: str) -> str:
        return f"{self.root}/{table}"


def run_job(
    spark: SparkSession,
    root: str,
    stream_path: str,
    snapshot_path: str | None = None,
    params: RunParams = RunParams(),
    refresh: bool = True,
) -> tuple[StationRun, dict]:
    """Run all steps once and write results, quarantine, metrics, alerts, drift events and models.

    Without ``refresh`` the stored master is used if it has rows. Each station and sensor has a lag model of its own,
    which later runs use again until that series drifts or the sensors change; a run fits only the series
    without a valid model. A run without readings writes nothing.
    """
    paths = JobPaths(root)
    master = MasterTable(paths.at("master"), tuple(params.sensors))
    before = master.total(spark)
    readings = master.read(spark)
    if refresh or readings.isEmpty():
        readings = ingest(spark, master, stream_path, snapshot_path)
    if readings.isEmpty():
        return StationRun(readings, readings, readings), {}
    models = ModelTable(root, tuple(params.sensors), params.primary, params.forecast.lookback)
    run = run_stations(readings, params, models=models)
    # Results and alerts read the table; the metrics come from its write.
    results, counts = materialize(run.results, "results", metric_columns(run.results))
    run = replace(run, results=results)
    metrics = append_run_metrics(results, paths.at("metrics"), max(master.total(spark) - before, 0), counts)
    number = metrics["run"]
    write_results(run.results, f"{paths.at('results')}/run={number}")
    append_quarantine(run.rejected.withColumn("run", F.lit(number).cast("long")), paths.at("quarantine"))
    alerts(run.results, ["station"], ["timestamp"], params.min_anomalies).write.mode("overwrite").parquet(
        f"{paths.at('alerts')}/run={number}"
    )
    if run.fitted is not None:
        models.commit(run.fitted, number)
    models.add_events(run.drift, number)
    return run, metrics


def drifted_stations(spark: SparkSession, root: str) -> DataFrame:
    """Stations with any drift event so far."""
    events = table_or_none(spark, JobPaths(root).at("drift_events"), EVENTS)
    events = spark.createDataFrame([], EVENTS) if events is None else events
    return drift_flags(events, ["station"])
