"""Readings from delimited text files with varying headers."""

from __future__ import annotations

import csv
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.normalize import header_name, normalize
from barograph.params import SENSORS

ORIGIN = ("source_file", "source_block", "source_row")


def separator_of(header: str) -> str:
    return "\t" if "\t" in header else ","


def header_cells(header: str) -> list[str]:
    return next(csv.reader([header.lstrip("﻿")], delimiter=separator_of(header)), [])


def file_rows(lines: DataFrame) -> DataFrame | None:
    """Rows of text lines (value, file, block, row) under the canonical names of each file's own header.

    Headers may differ in names, order and separator. A file's header is the first line of it that is not blank;
    lines that repeat it are no rows. The headers are a small table, one row per file, joined to the lines by file,
    and each line is parsed once, by its header; only the kinds of headers come to the driver, not the
    files. ``None`` without any header.
    """
    first = lines.filter((F.col(ORIGIN[1]) == 0) & (F.trim("value") != "")).groupBy(ORIGIN[0]).agg(
        F.min_by("value", ORIGIN[2]).alias("header")
    )
    kinds = {r["header"]: header_cells(r["header"]) for r in first.select("header").distinct().orderBy("header").collect()}
    if not kinds:
        return None
    rows = lines.filter(F.trim("value") != "")
    rows = rows.withColumn("header", F.lit(next(iter(kinds)))) if len(kinds) == 1 else rows.join(first, ORIGIN[0])
    rows = rows.filter(F.col("value") != F.col("header"))
    schema = ", ".join(f"_c{i} string" for i in range(max(map(len, kinds.values()))))
    by_tab, by_comma = (F.from_csv("value", schema, {"sep": sep}) for sep in ("\t", ","))
    tabs = [h for h in kinds if separator_of(h) == "\t"]
    cells = by_comma if not tabs else by_tab if len(tabs) == len(kinds) else F.when(F.col("header").isin(tabs), by_tab).otherwise(by_comma)
    rows = rows.select(cells.alias("cells"), "header", *ORIGIN)
    sources: dict[str, dict[str, list[Column]]] = {}
    for header, names in kinds.items():
        for i, name in enumerate(names):
            sources.setdefault(header_name(name), {}).setdefault(header, []).append(F.col(f"cells._c{i}"))
    columns = []
    for name, by_header in sources.items():
        cell = F.lit(None).cast("string")
        for header, found in by_header.items():
            cell = F.when(F.col("header") == header, F.coalesce(*found)).otherwise(cell)
        columns.append(cell.alias(name))
    return rows.select(*columns, *ORIGIN)


def read_delimited(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame | None:
    """All files below ``path`` as text columns under canonical names.

    ``source_file``, ``source_block`` and ``source_row`` keep file and row order. ``None`` when the
    path is missing or holds no readable file.
    """
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True)
    try:
        lines = reader.text(path).select(
            "value",
            F.col("_metadata.file_path").alias(ORIGIN[0]),
            F.col("_metadata.file_block_start").alias(ORIGIN[1]),
            F.monotonically_increasing_id().alias(ORIGIN[2]),
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return file_rows(lines)


def empty_readings(spark: SparkSession, sensors: Iterable[str] = SENSORS) -> DataFrame:
    fields = ", ".join(["station string", "timestamp timestamp_ntz", *[f"`{s}` double" for s in sensors]])
    return spark.createDataFrame([], fields)


def scan_readings(
    spark: SparkSession,
    path: str,
    sensors: Iterable[str] = SENSORS,
    glob: str = "*.csv",
    station: str = "0",
) -> DataFrame:
    """Normalized readings of a folder or file, one row per station and time.

    Later files and later rows win. ``station`` names the station of files that
    have no such column. A missing or empty path gives an empty typed frame.
    """
    sensors = list(sensors)
    raw = read_delimited(spark, path, glob)
    if raw is None:
        return empty_readings(spark, sensors)
    if "station" not in raw.columns:
        raw = raw.withColumn("station", F.lit(station))
    raw = raw.withColumn("station", F.coalesce(F.col("station").cast("string"), F.lit(station)))
    clean = normalize(raw, sensors, ("station", "timestamp"), ORIGIN)
    return clean.select("station", "timestamp", *sensors)
