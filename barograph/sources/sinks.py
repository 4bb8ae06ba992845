"""Result, quarantine, metrics and model tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.report import run_metrics


def write_results(df: DataFrame, path: str, file_format: str = "parquet", by: Iterable[str] = ("station",)) -> None:
    """Write results partitioned by column; a heavy partition value is split over several tasks."""
    by = list(by)
    writer = df.hint("rebalance", *by).write.mode("overwrite").format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.partitionBy(*by).save(path)


def append_quarantine(rejected: DataFrame, path: str) -> None:
    rejected.write.mode("append").parquet(path)


def table_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


METRICS = "run long, records_total long, anomalies long, new_records_last_run long"


def append_run_metrics(df: DataFrame, path: str, new_records: int, counts: dict | None = None) -> dict:
    """Append the metrics of a run; the run number counts the runs before it.

    ``counts`` are those that the write of ``df`` has observed; without them the rows are counted.
    """
    spark = df.sparkSession
    earlier = table_or_none(spark, path, METRICS)
    run = (earlier.count() if earlier is not None else 0) + 1
    counts = counts or run_metrics(df).first()
    row = (run, counts["records_total"], counts["anomalies"], new_records)
    spark.createDataFrame([row], METRICS).coalesce(1).write.mode("append").parquet(path)
    return dict(zip(("run", "records_total", "anomalies", "new_records_last_run"), row))


def schema_hash(sensors: Iterable[str], primary: str) -> Column:
    """Fingerprint of the sensor list and the primary sensor a model was fitted for."""
    return F.sha2(F.lit("|".join([*sensors, primary])), 256)


def stale_models(models: DataFrame, series: DataFrame, keys: Iterable[str], wanted: Column) -> DataFrame:
    """Series without a model, or whose model was fitted for other sensors."""
    keys = list(keys)
    fitted = models.select(*keys, F.col("schema_hash").alias("_have"))
    joined = series.select(*keys).distinct().join(fitted, keys, "left")
    return joined.filter(F.col("_have").isNull() | (F.col("_have") != wanted)).select(*keys)
