"""The table of fitted models: one row per series and fit, the last fit counts.

A run refits the series that have no model for the present sensors, and those with a drift event that is
younger than their model. Writing the new models is what consumes the events: an event counts as long as no model of a later run
exists, so there is no marker to keep in step, and a run that fails before it writes consumes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.drift import retrain_list
from barograph.sources.sinks import schema_hash, stale_models, table_or_none

KEYS = ("station", "sensor")
EVENTS = "station string, sensor string, p_value double, drift int, run long"
MODELS = "station string, sensor string, windows long, intercept double, coefficients array<double>, rmse double, " \
    "schema_hash string, run long"


@dataclass(frozen=True)
class ModelTable:
    """Models and drift events below ``root``; models are valid for ``sensors``, ``primary`` and ``lookback``."""

    root: str
    sensors: tuple[str, ...]
    primary: str
    lookback: int

    @property
    def wanted(self) -> Column:
        return schema_hash([*self.sensors, str(self.lookback)], self.primary)

    def _table(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        found = table_or_none(spark, f"{self.root}/{name}", schema)
        return spark.createDataFrame([], schema) if found is None else found

    def current(self, spark: SparkSession) -> DataFrame:
        """The last fit of each series, also of series fitted for other sensors."""
        models = self._table(spark, "models", MODELS)
        rest = [c for c in models.columns if c not in KEYS]
        last = models.groupBy(*KEYS).agg(F.max_by(F.struct(*rest), "run").alias("last"))
        return last.select(*KEYS, "last.*")

    def events(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, "drift_events", EVENTS)

    def to_refit(self, spark: SparkSession, series: DataFrame) -> DataFrame:
        """The series (station, sensor) of ``series`` without a valid model or with an unconsumed drift event."""
        current = self.current(spark)
        wanted = series.select(*[F.col(k).cast("string").alias(k) for k in KEYS]).distinct()
        stale = stale_models(current, wanted, KEYS, self.wanted)
        events = self.events(spark).filter(F.col("drift") == 1)
        consumed = events.join(current.select(*KEYS, F.col("run").alias("_fit")), list(KEYS)).filter(F.col("_fit") > F.col("run"))
        drifted = retrain_list(events, consumed.select(*KEYS, "run").distinct(), [*KEYS, "run"]).select(*KEYS).distinct()
        return stale.union(drifted.join(wanted, list(KEYS), "left_semi")).distinct()

    def valid(self, spark: SparkSession, listed: DataFrame, fitted: DataFrame) -> DataFrame:
        """The models to use: those just fitted, and the current ones of all series that weren't listed."""
        kept = self.current(spark).filter(F.col("schema_hash") == self.wanted)
        kept = kept.join(listed, list(KEYS), "left_anti")
        columns = [*KEYS, "intercept", "coefficients"]
        return kept.select(*columns).unionByName(fitted.select(*columns))

    def commit(self, fitted: DataFrame, run: int) -> None:
        """Add the fits of a run, which consumes the events of earlier runs of their series."""
        rows = fitted.withColumns(
            {"schema_hash": self.wanted, "run": F.lit(run).cast("long")}
        )
        rows.select([f.split(" ")[0] for f in MODELS.split(", ")]).write.mode("append").parquet(f"{self.root}/models")

    def add_events(self, drift: DataFrame, run: int) -> None:
        """Add the drift found by a run; smoothed columns go by the name of their sensor."""
        sensor = F.regexp_replace("sensor", "_filt$", "").alias("sensor")
        found = drift.filter(F.col("drift") == 1).withColumn("run", F.lit(run).cast("long"))
        found = found.select(F.col("station").cast("string").alias("station"), sensor, "p_value", "drift", "run")
        found.write.mode("append").parquet(f"{self.root}/drift_events")

