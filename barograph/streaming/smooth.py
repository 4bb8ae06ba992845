"""Median and adaptive Kalman smoothing with state carried between micro-batches.

``stream_smooth`` keeps its state in Structured Streaming, one group per series and micro-batch. ``stream_smooth_table``
is for streams with very long series in a micro-batch: each micro-batch goes through the operator for blocks, where
many tasks reduce a series, and only a row per series is carried, in a table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barograph.operators.smooth import kalman_smooth
from barograph.params import KalmanParams, SeriesSpec
from barograph.plans.layout import POS, attach, index_series
from barograph.session import materialize, remove
from barograph.sources.sinks import table_or_none

_STATE = "recent array<double>, medians array<double>, x double, p double, r double, last_ts timestamp_ntz, last_seq long"


def stream_smooth(stream: DataFrame, keys: Iterable[str] = ("station", "sensor"), params: KalmanParams = KalmanParams()):
    """Add ``value_filt`` to a stream of (keys, ts, seq, value).

    Rows are sorted within a micro-batch. A row older than the state comes out
    with ``late`` set and no smoothed value, for a side table. A missing value
    repeats the one before; before the first value the result is null.
    """
    keys = list(keys)
    types = dict((f.name, f.dataType.simpleString()) for f in stream.schema.fields)
    output = ", ".join(f"`{k}` {types[k]}" for k in keys)
    output += ", ts timestamp_ntz, seq long, value double, value_filt double, late boolean"

    def smooth(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches)).sort_values(["ts", "seq"], kind="stable").reset_index(drop=True)
        if state.exists:
            recent, medians, x, p, r, last_ts, last_seq = state.get
            recent, medians, last = list(recent), list(medians), (pd.Timestamp(last_ts), last_seq)
        else:
            recent, medians, last = [], [], None
            x, p, r = None, params.estimated_error, params.measurement_variance
        out, late = np.full(len(pdf), np.nan), np.zeros(len(pdf), dtype=bool)
        for i, (ts, seq, value) in enumerate(zip(pdf["ts"], pdf["seq"], pdf["value"].to_numpy(float).tolist())):
            if last is not None and (ts, seq) <= last:
                late[i] = True
                continue
            if value != value:
                if not recent:
                    continue
                value = recent[-1]
            last = (ts, seq)
            recent = (recent + [value])[-params.median_window :]
            median = float(np.median(recent))
            x = median if x is None else x
            medians = (medians + [median])[-params.history :]
            if len(medians) >= params.min_history:
                noise = max(float(np.var(medians)), params.min_variance)
                r = (1.0 - params.adaptation_rate) * r + params.adaptation_rate * noise
            p = p + params.process_variance
            gain = p / (p + r)
            x = x + gain * (median - x)
            p = (1.0 - gain) * p
            out[i] = x
        if last is not None:
            state.update((recent, medians, x, p, r, last[0].to_pydatetime(), int(last[1])))
        pdf["value_filt"], pdf["late"] = out, late
        for k, v in zip(keys, key):
            pdf[k] = v
        yield pdf[[*keys, "ts", "seq", "value", "value_filt", "late"]]

    rows = stream.select(*keys, "ts", "seq", "value")
    return rows.groupBy(*keys).applyInPandasWithState(smooth, output, _STATE, "append", GroupStateTimeout.NoTimeout)


_CARRIED = "tail array<double>, noise double, error double, x double, last_ts timestamp_ntz, last_seq long"


def smooth_batch(
    rows: DataFrame, state: DataFrame, keys: Iterable[str], params: KalmanParams = KalmanParams(), block_rows: int = 262_144
) -> tuple[DataFrame, DataFrame]:
    """(rows with ``value_filt`` and ``late``, the state after them) of a micro-batch (keys, ts, seq, value).

    The state has one row per series: its last filled values, as many as the windows reach back, and the noise,
    error and value it ended with. Rows not behind the state's last row are late. Rows before the first value of a
    series have no smoothed value.
    """
    keys, at = list(keys), F.struct("ts", "seq")
    known = state.select(*keys, F.struct("last_ts", "last_seq").alias("_last"), F.col("noise").alias("_noise0_value"),
                         F.col("error").alias("_error0_value"), F.col("x").alias("_value0_value"))
    seen = rows.select(*keys, "ts", "seq", "value").join(known, keys, "left")
    seen = seen.withColumn("late", F.coalesce(at <= F.col("_last"), F.lit(False)))
    first = seen.filter("_last IS NULL AND value IS NOT NULL").groupBy(*keys).agg(F.min(at).alias("_first"))
    seen = seen.join(first, keys, "left")
    begun = F.col("_last").isNotNull() | F.coalesce(at >= F.col("_first"), F.lit(False))
    seen = materialize(seen.withColumn("_live", ~F.col("late") & begun).drop("_last", "_first"), "stream-rows")
    carried = ["_noise0_value", "_error0_value", "_value0_value"]
    body = seen.filter("_live").select(*keys, F.lit(1).alias("_part"), "ts", "seq", "value", "_live", *carried)
    before = state.join(body.select(*keys).distinct(), keys, "left_semi").select(
        *keys, F.lit(0).alias("_part"), F.col("last_ts").alias("ts"), F.posexplode("tail").alias("_at", "value"),
        F.lit(False).alias("_live"), F.col("noise").alias(carried[0]), F.col("error").alias(carried[1]),
        F.col("x").alias(carried[2]),
    )
    before = before.withColumn("seq", F.col("_at").cast("long")).select(*body.columns)
    spec = SeriesSpec(tuple(keys), ("_part", "ts", "seq"), block_rows)
    df, spec = index_series(before.unionByName(body), spec)
    made = materialize(kalman_smooth(df, spec, ["value"], params, carried=True), "stream-smoothed")

    reach = params.median_window + params.history - 2
    ends = made.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.max_by(F.struct("value_noise", "value_error", "value_filt", "ts", "seq"), POS).alias("end"),
    )
    tails = attach(made.select(*keys, POS, "value_filled"), ends.select(*keys, "n"), spec).filter(F.col(POS) >= F.col("n") - reach)
    tails = tails.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(POS, "value_filled"))).alias("tail"))
    after = ends.join(tails, keys).select(
        *keys, F.col("tail.value_filled").alias("tail"), F.col("end.value_noise").alias("noise"),
        F.col("end.value_error").alias("error"), F.col("end.value_filt").alias("x"), F.col("end.ts").alias("last_ts"),
        F.col("end.seq").alias("last_seq"),
    )
    columns = [*keys, "ts", "seq", "value", "value_filt", "late"]
    smoothed = made.filter("_live").withColumn("late", F.lit(False)).select(*columns)
    others = seen.filter("NOT _live").withColumn("value_filt", F.lit(None).cast("double")).select(*columns)
    kept = state.join(after.select(*keys), keys, "left_anti").select(*after.columns)
    return smoothed.unionByName(others), after.unionByName(kept)


def stream_smooth_table(
    stream: DataFrame,
    out: str,
    state: str,
    checkpoint: str,
    keys: Iterable[str] = ("station", "sensor"),
    params: KalmanParams = KalmanParams(),
    block_rows: int = 262_144,
    interval: str | None = None,
) -> StreamingQuery:
    """Write a stream of (keys, ts, seq, value) with ``value_filt`` below ``out``, one folder per micro-batch.

    The state of micro-batch N is a table of its own, made from that of the one before, so a repeated micro-batch gives the same
    rows and state again. Tables that no micro-batch can ask for any more are removed. ``interval=None`` handles what is there and stops.
    """
    keys = list(keys)
    types = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + f", {_CARRIED}"

    def smooth(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = materialize(batch.select(*keys, "ts", "seq", "value"), "stream-batch")
        held = table_or_none(spark, f"{state}/batch={number - 1}", schema) if number else None
        held = spark.createDataFrame([], schema) if held is None else held
        made, after = smooth_batch(rows, held, keys, params, block_rows)
        made.write.mode("overwrite").parquet(f"{out}/batch={number}")
        after.write.mode("overwrite").parquet(f"{state}/batch={number}")
        remove(spark, f"{state}/batch={number - 2}")

    writer = stream.writeStream.foreachBatch(smooth).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
