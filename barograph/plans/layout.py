"""Positions and blocks: how one long series is spread over many tasks.

Row-counting windows need the rows of a series in order. A window over the whole
series puts it into one task, which fails when a single station holds a third of
the data. So every row first gets its position in its series, and then a block
number ``pos div block_rows``. Windows run per block, with a halo of copied rows
for the look-back, and values that run through a whole series are carried from
block to block by a small table with one row per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barograph.params import SeriesSpec
from barograph.session import materialize

POS = "pos"
BLOCK = "_block"
OWN = "_own"

_ROWS_PER_RANGE = 4_000_000
_MAX_RANGES = 32_768


def index_series(df: DataFrame, spec: SeriesSpec) -> tuple[DataFrame, SeriesSpec]:
    """Add ``pos``, the 0-based row number within the series.

    One counting job (partially aggregated, key columns only) finds the longest
    series. If that fits into one block, a plain window numbers the rows. If it
    does not, the rows are range-partitioned on (keys, order), which splits a hot
    series over many tasks, and numbered from per-task counts.

    Key columns must not be null. Index again after dropping rows.
    """
    sizes = df.groupBy(*spec.keys).count()
    seen = sizes.agg(
        F.max("count").alias("longest"), F.min("count").alias("shortest"), F.sum("count").alias("total")
    ).first()
    spec = spec.sized(seen["longest"] or 0, seen["shortest"] or 0)
    if spec.one_block:
        w = Window.partitionBy(*spec.keys).orderBy(*spec.order)
        return df.withColumn(POS, F.row_number().over(w).cast("long") - 1), spec
    return _number_by_range(df, spec, seen["total"]), spec


def _number_by_range(df: DataFrame, spec: SeriesSpec, total: int) -> DataFrame:
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // _ROWS_PER_RANGE)
    by = [*spec.keys, *spec.order]
    # The row ids depend on the task layout, so they are written down once.
    ranged = materialize(
        df.repartitionByRange(min(ranges, _MAX_RANGES), *by)
        .sortWithinPartitions(*by)
        .withColumn("_rid", F.monotonically_increasing_id()),
        "series",
    ).withColumn("_range", F.shiftright("_rid", 33))
    parts = ranged.groupBy(*spec.keys, "_range").agg(
        F.min("_rid").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy(*spec.keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return (
        ranged.join(parts, [*spec.keys, "_range"])
        .withColumn(POS, F.col("_rid") - F.col("_first") + F.col("_offset"))
        .drop("_rid", "_range", "_first", "_rows", "_offset")
    )


def split_blocks(df: DataFrame, spec: SeriesSpec, before: int = 0, after: int = 0) -> DataFrame:
    """Add the block number, with ``before``/``after`` halo rows copied into it.

    ``_own`` marks the one copy of a row that belongs to its block.
    """
    if spec.blocked:
        return df
    if spec.one_block:
        return df.withColumn(BLOCK, F.lit(0).cast("long")).withColumn(OWN, F.lit(True))
    size = spec.block_rows
    home = F.expr(f"{POS} div {size}")
    if not before and not after:
        return df.withColumn(BLOCK, home).withColumn(OWN, F.lit(True))
    first = F.expr(f"greatest({POS} - {after}, 0) div {size}")
    last = F.expr(f"({POS} + {before}) div {size}")
    return df.withColumn(BLOCK, F.explode(F.sequence(first, last))).withColumn(OWN, F.col(BLOCK) == home)


def spread(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Hash rows by key into a fixed number of tasks.

    For work that is heavy per byte, such as model fits: adaptive execution would
    merge its small inputs into a single task.
    """
    spark = df.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *keys)


def block_window(spec: SeriesSpec) -> WindowSpec:
    return Window.partitionBy(*spec.keys, BLOCK).orderBy(POS)


def merge_blocks(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Keep the owned copies and drop the block columns."""
    if spec.blocked:
        return df
    if not spec.one_block:
        df = df.filter(F.col(OWN))
    return df.drop(BLOCK, OWN)


@dataclass(frozen=True)
class Step:
    """An operator of a chain, and how many rows before and after a row it looks at."""

    run: Callable[[DataFrame, SeriesSpec], DataFrame]
    before: int = 0
    after: int = 0


def run_chain(df: DataFrame, spec: SeriesSpec, steps: Iterable[Step]) -> DataFrame:
    """Run row-counting operators one on top of the other with a single exchange.

    The rows are cut into blocks once, with a halo as wide as all steps together, and stay in place by
    (keys, block) until the end; each step leaves one step's reach of the halo incomplete, which never gets as far as
    the owned rows. A step must look at its block only: it may use ``block_window``, but not join or aggregate.
    """
    steps = list(steps)
    blocks = split_blocks(df, spec, sum(s.before for s in steps), sum(s.after for s in steps))
    for step in steps:
        blocks = step.run(blocks, replace(spec, blocked=True))
    return merge_blocks(blocks, spec)


def series_sizes(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per series with its row count ``n``."""
    return df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n"))


def join_series(df: DataFrame, stats: DataFrame, spec: SeriesSpec, rows: str = "n", how: str = "inner") -> DataFrame:
    """Attach per-series values to the rows of a blocked frame.

    ``stats`` holds one row per series and its row count in column ``rows``. It is
    repeated once per block, so the join key (keys, block) never gathers more than
    one block of rows, however long the series is.
    """
    if spec.one_block:
        return df.join(stats, list(spec.keys), how)
    blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"({rows} - 1) div {spec.block_rows}"))
    return df.join(stats.withColumn(BLOCK, F.explode(blocks)), [*spec.keys, BLOCK], how)


def attach(df: DataFrame, stats: DataFrame, spec: SeriesSpec, how: str = "inner") -> DataFrame:
    """Attach per-series values (with a column ``n``) to an indexed frame."""
    return merge_blocks(join_series(split_blocks(df, spec), stats, spec, how=how), spec)


def with_size(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Add the row count ``n`` of the series to each row."""
    return attach(df, series_sizes(df, spec), spec)


def min_by_position(column: str) -> Column:
    """First non-null value of a group, in position order."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(POS)))


def max_by_position(column: str) -> Column:
    """Last non-null value of a group, in position order."""
    return F.max_by(column, F.when(F.col(column).isNotNull(), F.col(POS)))


def fill_gaps(df: DataFrame, spec: SeriesSpec, columns: Iterable[str]) -> DataFrame:
    """Forward fill, then fill the leading gap with the first value of the series.

    The last value of each block is carried to the blocks after it.
    """
    columns = list(columns)
    others = [c for c in df.columns if c not in columns]
    blocks = split_blocks(df, spec)
    running = block_window(spec).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*spec.keys)
    if spec.one_block:
        filled = blocks.select(
            *others,
            *[F.last(c, ignorenulls=True).over(running).alias(c) for c in columns],
            *[F.first_value(c, ignoreNulls=True).over(block_window(spec).rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"_f_{c}") for c in columns],
        )
        return filled.select(*[F.coalesce(c, f"_f_{c}").alias(c) if c in columns else c for c in df.columns])
    ends = blocks.groupBy(*spec.keys, BLOCK).agg(
        *[max_by_position(c).alias(f"_l_{c}") for c in columns],
        *[min_by_position(c).alias(f"_f_{c}") for c in columns],
    )
    earlier = Window.partitionBy(*spec.keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    first_block = {c: F.min_by(f"_f_{c}", F.when(F.col(f"_f_{c}").isNotNull(), F.col(BLOCK))) for c in columns}
    carries = ends.select(
        *spec.keys,
        BLOCK,
        *[
            F.coalesce(F.last(f"_l_{c}", ignorenulls=True).over(earlier), first_block[c].over(whole)).alias(f"_c_{c}")
            for c in columns
        ],
    )
    filled = blocks.withColumns({c: F.last(c, ignorenulls=True).over(running) for c in columns})
    filled = filled.join(carries, [*spec.keys, BLOCK])
    return filled.select(*[F.coalesce(c, f"_c_{c}").alias(c) if c in columns else c for c in df.columns])


def exact_quantile(df: DataFrame, keys: Iterable[str], column: str, share: float, bins: int = 65_536) -> DataFrame:
    """Exact interpolated quantile of a column with values in [0, 1], per group.

    A histogram (partially aggregated) finds the bins that hold the two order
    statistics; only the distinct values of those bins are then counted.
    """
    keys = list(keys)
    values = df.filter(F.col(column).isNotNull()).select(
        *keys, F.col(column).alias("_v"), F.least(F.floor(F.col(column) * bins), F.lit(bins - 1)).alias("_bin")
    )
    running = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    place = (F.col("_n") - 1) * F.lit(share)
    hist = (
        values.groupBy(*keys, "_bin")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_upto", F.sum("_rows").over(running))
        .withColumn("_n", F.sum("_rows").over(whole))
        .withColumn("_lo", F.floor(place))
        .withColumn("_hi", F.ceil(place))
        .withColumn("_part", place - F.floor(place))
        .withColumn("_before", F.col("_upto") - F.col("_rows"))
    )
    holds = [(F.col("_before") <= F.col(k)) & (F.col(k) < F.col("_upto")) for k in ("_lo", "_hi")]
    wanted = hist.filter(holds[0] | holds[1]).select(*keys, "_bin", "_before", "_lo", "_hi", "_part")
    # The histogram is bounded by bins x groups, the wanted bins by two per group.
    counted = values.join(wanted, [*keys, "_bin"]).groupBy(*keys, "_bin", "_before", "_lo", "_hi", "_part", "_v").agg(
        F.count(F.lit(1)).alias("_same")
    )
    inside = Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_end", F.col("_before") + F.sum("_same").over(inside)).withColumn(
        "_start", F.col("_end") - F.col("_same")
    )
    at = lambda k: F.max(F.when((F.col("_start") <= F.col(k)) & (F.col(k) < F.col("_end")), F.col("_v")))
    picked = ranked.groupBy(*keys, "_part").agg(at("_lo").alias("_a"), at("_hi").alias("_b"))
    return picked.select(*keys, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")).alias("cut"))
