"""Streaming ingestion into the master table, and alerts per micro-batch."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barograph.operators.normalize import normalize
from barograph.operators.report import alerts
from barograph.operators.validate import split_valid
from barograph.params import BOUNDS
from barograph.session import materialize
from barograph.sources.csvfiles import ORIGIN, file_rows
from barograph.sources.master import MasterTable


def first_within(
    stream: DataFrame, keys: Iterable[str] = ("station", "timestamp"), time: str = "timestamp", delay: str = "10 minutes"
) -> DataFrame:
    """The first row of each key, for streams that cannot keep every key: an option with bounded state.

    Unlike the master table, where the last reading of a key wins however late it comes, a repeated key is dropped
    as long as it comes within ``delay`` of the newest time seen; state older than that is forgotten. For
    rows no later than ``delay`` the result is that of a batch.
    """
    at = F.col(time).cast("timestamp")  # a watermark needs an instant; the session's zone is UTC
    marked = stream.withColumn("_at", at).withWatermark("_at", delay)
    return marked.dropDuplicatesWithinWatermark(list(keys)).drop("_at")


def stream_ingest(
    spark: SparkSession,
    landing: str,
    master: MasterTable,
    checkpoint: str,
    quarantine: str | None = None,
    bounds: Mapping[str, tuple[float, float]] = BOUNDS,
    interval: str | None = "60 seconds",
    station: str = "0",
) -> StreamingQuery:
    """Poll ``landing`` for delimited files and merge their valid rows into the master.

    Each file is read by its own header, as in a batch; ``station`` names the station of rows without one. Rows
    may come arbitrarily late: the master keeps the last value of each key. A repeated micro-batch is
    recognised by its number and the id of the streaming query, which lives in its checkpoint: batches
    after a new checkpoint are new. ``interval=None`` handles what is there and stops.
    """
    lines = spark.readStream.text(landing).select(
        "value", F.col("_metadata.file_path").alias(ORIGIN[0]), F.col("_metadata.file_block_start").alias(ORIGIN[1])
    )

    def merge(batch: DataFrame, number: int) -> None:
        run = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()["value"]
        run = json.loads(run)["id"]
        raw = file_rows(materialize(batch.withColumn(ORIGIN[2], F.monotonically_increasing_id()), "lines"))
        if raw is None:
            return
        named = F.col("station") if "station" in raw.columns else F.lit(None)
        named = F.when(F.trim(named.cast("string")) != "", named.cast("string"))
        raw = raw.withColumn("station", F.coalesce(named, F.lit(station)))
        clean = materialize(normalize(raw, master.sensors, ("station", "timestamp"), ORIGIN), "clean")
        valid, rejected = split_valid(clean, bounds, master.sensors)
        master.upsert(valid, f"stream:{landing}:{run}", number)
        if quarantine:
            rejected.write.mode("overwrite").parquet(f"{quarantine}/run={run}/batch={number}")

    writer = lines.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def stream_alerts(
    flagged: DataFrame,
    keys: Iterable[str],
    order: Iterable[str],
    path: str,
    checkpoint: str,
    min_anomalies: int = 1,
    interval: str | None = None,
) -> StreamingQuery:
    """Write the alert rows of every micro-batch of a flagged stream.

    With an ``interval`` (such as "60 seconds") it looks again and again until it is stopped; without, it handles what is
    there and stops.
    """
    keys, order = list(keys), list(order)

    def write(batch: DataFrame, number: int) -> None:
        found = alerts(batch, keys, order, min_anomalies)
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = flagged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
