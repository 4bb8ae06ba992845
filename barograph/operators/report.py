"""Alerts, run metrics and Markdown reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barograph.operators.anomaly import anomalous

# Texts of the report.
REPORT_TITLE = "Predicted Atmospheric Data"
TOTAL_LINE = "- Total CSV rows: "
INCLUDED_LINE = "- Rows included in this upload: "


def _flagged(df: DataFrame) -> Column:
    if "anomaly_combined" in df.columns:
        return F.col("anomaly_combined") == 1
    if "anomaly" in df.columns:
        return F.col("anomaly") == -1
    return F.lit(False)


def first_rows(df: DataFrame, keys: Iterable[str], order: Iterable[str], rows: int) -> DataFrame:
    """The first rows of each group with their number; Spark cuts the groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("row", F.row_number().over(w)).filter(F.col("row") <= rows)


def alert_sample(df: DataFrame, keys: Iterable[str], order: Iterable[str], rows: int = 5) -> DataFrame:
    """The first anomalous rows of each group."""
    return first_rows(anomalous(df), keys, order, rows)


def alert_summary(df: DataFrame, keys: Iterable[str], min_anomalies: int = 1) -> DataFrame:
    """Rows, anomalies and their share in percent, for groups with enough anomalies."""
    total, found = F.col("total_records"), F.col("anomaly_count")
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("total_records"), F.count(F.when(_flagged(df), 1)).alias("anomaly_count"))
        .withColumn("anomaly_pct", F.when(total > 0, F.round(100 * found / total, 2)).otherwise(0.0))
        .filter(found >= min_anomalies)
    )


def alerts(df: DataFrame, keys: Iterable[str], order: Iterable[str], min_anomalies: int = 1, rows: int = 5):
    """Summary with the sample as an array of rows."""
    keys, order = list(keys), list(order)
    shown = [c for c in df.columns if c not in keys]
    sample = alert_sample(df, keys, order, rows).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("row", *shown))).alias("sample")
    )
    return alert_summary(df, keys, min_anomalies).join(sample, keys, "left")


def run_metrics(df: DataFrame) -> DataFrame:
    """One row: records and anomalies of a run."""
    return df.agg(*[c.alias(name) for name, c in metric_columns(df).items()])


def metric_columns(df: DataFrame) -> dict[str, Column]:
    """The aggregates of ``run_metrics``, for a write that observes them."""
    return {"records_total": F.count(F.lit(1)), "anomalies": F.count(F.when(_flagged(df), 1))}


def _cell(column: str) -> Column:
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("|"), F.lit("\\|"))


def markdown_report(
    df: DataFrame, keys: Iterable[str], columns: Iterable[str], order: Iterable[str], max_rows: int = 200
) -> DataFrame:
    """One Markdown document per group: counts and a table of its first rows."""
    keys, columns = list(keys), list(columns)
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[_cell(c) for c in columns]), F.lit(" |"))
    lines = (
        first_rows(df, keys, order, max_rows)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("row", line.alias("line")))).alias("lines"))
    )
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"))
    head = [
        F.lit(f"# {REPORT_TITLE}"),
        F.lit(""),
        F.concat(F.lit(TOTAL_LINE), F.col("total").cast("string")),
        F.concat(F.lit(INCLUDED_LINE), F.size("lines").cast("string")),
        F.lit(""),
        F.lit("| " + " | ".join(columns) + " |"),
        F.lit("| " + " | ".join(["---"] * len(columns)) + " |"),
    ]
    body = F.concat(F.array(*head), F.transform("lines", lambda x: x["line"]), F.array(F.lit("")))
    return lines.join(totals, keys).select(*keys, F.array_join(body, "\n").alias("document"))
