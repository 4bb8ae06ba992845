"""Session helpers: a local session for tests, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_local_roots: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "barograph") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    threads = os.cpu_count() if cores == "*" else int(cores)
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(max(threads or 1, 1)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def work_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder of the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="barograph-")
    return _local_roots[app]


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{work_root(spark)}/barograph/{label}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, label: str, seen: dict[str, Column] | None = None) -> DataFrame | tuple[DataFrame, dict]:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and values that depend on task layout keep the value they were written with. With aggregates to be ``seen``
    their values over the rows come too, observed by the write itself.
    """
    spark = df.sparkSession
    if seen:
        watch = Observation()
        table = materialize(df.observe(watch, *[c.alias(name) for name, c in seen.items()]), label)
        return table, watch.get
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
